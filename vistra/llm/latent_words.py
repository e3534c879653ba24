"""A hidden Markov language model, trained by Baum-Welch over all training texts.

Tokens are lower-cased words and one end for each text. A hidden state emits a
spelling or word class, and the class emits the word:

- The words that make up at least one in ``OWN_SHARE`` training tokens, the end
  included, are classes of their own; there are at most ``OWN_SHARE`` of them.
- All others, unknown ones too, are classed by their last bytes and length into
  ``SPELLINGS`` classes. In its class a word has the probability (c + 1) / (C + V + 1), where c
  counts the word over all training texts, C and V the class's tokens and
  different words; the 1 left over belongs to an unknown word.

So the counts of all words enter, however many there are, and what the states tell
apart is a table of bounded size that travels to the tasks. A state's class
probabilities are its expected counts, smoothed by the classes' shares in the
counts of single words (add one). All of it sums to one over known words and one
unknown word for each spelling class.

Passes over the data: words are numbered within blocks of texts; (word, count)
rows of all blocks are summed; counts go back to the blocks as one row each, by
block. What is kept then is a class number for each token and the sum of
everything that doesn't depend on states. Each round of Baum-Welch reads
those, adds expected counts within a task and sums them over tasks by class. The
rounds start from a model of a bounded sample (START_PIECES pieces of texts),
which only chooses where they begin. Training sequences are pieces of up to
PIECE tokens of a text; every token of every training text is in one.

A text's likelihood is exact: the scaled forward recursion over all its tokens.
Texts of a block go forward together, a token of each at a time; of a text
beyond LONG tokens, each stretch of STRETCH tokens goes forward from all states
at once, and the stretches are chained.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import Words, in_groups, mix64, stored, table, texts_of, trimmed

STATES = 8
OWN_SHARE = 1 << 15
SPELLINGS = 1 << 12
ROUNDS = 3
# Starting model: pieces drawn by a hash of their content, and its rounds.
START_PIECES, START_ROUNDS = 1200, 12
PIECE = 256
BLOCK_TOKENS = 1 << 20
LONG, STRETCH = 4096, 512
# Pieces that go forward and backward together.
TOGETHER = 1024
# Tokens between two scalings of a recursion; so many probabilities' product is far from what a double can't hold.
SCALE_EVERY = 8
# Weight, in expected tokens, of the classes' shares in a state's probabilities, and of even transitions.
SHARE_WEIGHT, EVEN_WEIGHT = 50.0, 5.0
END = np.uint64(0x656E64206F662E2E)  # the end's hash
CLASSES = OWN_SHARE + SPELLINGS


def held_out(key: str) -> Column:
    """Rows that the model doesn't learn from; a null id is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def word_names(words: Words) -> np.ndarray:
    """Each word's 64-bit name; the lowest bits are its spelling class: last two bytes and length up to 15, by hash."""
    last = words.buf[words.stop - 1].astype(np.uint64)
    size = np.minimum(words.stop - words.start, 15).astype(np.uint64)
    second = np.where(size > 1, words.buf[np.maximum(words.stop - 2, 0)], 0).astype(np.uint64)
    kind = mix64((last << np.uint64(16)) + (second << np.uint64(8)) + size) % np.uint64(SPELLINGS)
    return words.hash // np.uint64(SPELLINGS) * np.uint64(SPELLINGS) + kind


def spelling(names: np.ndarray) -> np.ndarray:
    return (names.view(np.uint64) % np.uint64(SPELLINGS)).astype(np.int64)


# --- blocks of numbered words --------------------------------------------------------------

# A block's number and a word's place in it share a long: so many bits for the place, and for
# the block's place in its task. A block is some BLOCK_TOKENS tokens, or one text with more.
PLACE_BITS, TURN_BITS = 24, 17
# A reply to a block is the word's place over its count (of a word that isn't a class of its own).
COUNT_BITS = 63 - PLACE_BITS

_BLOCK = "block bigint, keys binary, gone binary, held binary, sizes binary, tokens binary, words array<bigint>, uses array<int>"
_BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64())] + [(c, pa.binary()) for c in ("keys", "gone", "held", "sizes", "tokens")]
    + [("words", pa.list_(pa.int64())), ("uses", pa.list_(pa.int32()))]
)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers of up to 24 bits, by byte planes and compressed: frequent words have low places, so most high bytes are 0."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T)
    return np.array([len(values)], "<i8").tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    planes = np.frombuffer(pa.decompress(memoryview(data)[8:], 3 * n, codec="zstd"), np.uint8).reshape(3, n)
    out = np.zeros((n, 4), np.uint8)
    out[:, :3] = planes.T
    return out.view("<u4").ravel()


def number_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored blocks of texts: their ids, and tokens as places among the block's different words, frequent ones first."""
    source = docs.select(F.col(key).cast("bigint").alias("_key"), held_out(key).alias("_held"), F.col(text).cast("string").alias("_text"))

    def number(batches):
        from pyspark import TaskContext

        block, parts, tokens = TaskContext.get().partitionId() << TURN_BITS, [], 0

        def flush():
            keys, gone, held, sizes = (np.concatenate([p[i] for p in parts]) for i in range(4))
            words, place, times = np.unique(np.concatenate([p[4] for p in parts]), return_inverse=True, return_counts=True)
            if len(words) > 1 << PLACE_BITS:
                raise ValueError(f"a text has {len(words)} different words, more than {1 << PLACE_BITS}")
            order = np.argsort(-times, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words, place = words[order], rank[place]
            uses = np.bincount(place[np.repeat(~held, sizes)], minlength=len(words))
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64())]
                + [pa.array([v], pa.binary()) for v in (keys.astype("<i8").tobytes(), gone.tobytes(), held.tobytes(), sizes.astype("<i8").tobytes(), squeezed(place))]
                + [pa.array([v], pa.list_(t)) for v, t in ((words.view(np.int64), pa.int64()), (uses.astype(np.int32), pa.int32()))],
                schema=_BLOCK_SCHEMA,
            )

        for batch in batches:
            keys, texts, at = batch.column("_key"), texts_of(batch, "_text"), 0
            ids, gone = keys.fill_null(0).to_numpy(), np.asarray(keys.is_null())
            held = np.asarray(batch.column("_held"))
            for group in in_groups(texts):
                words = Words(group, lower=True)
                sizes = np.diff(words.first)
                s = slice(at, at + len(group))
                parts.append((ids[s], gone[s], held[s], sizes + 1, np.insert(word_names(words), words.first[1:], END)))  # the end stands after a text's last word
                at += len(group)
                tokens += len(words.hash) + len(group)
                if tokens >= BLOCK_TOKENS:
                    yield flush()
                    block, parts, tokens = block + 1, [], 0
        if parts:
            yield flush()

    return stored(source.mapInArrow(trimmed(number), _BLOCK), "words-blocks")


def count_words(blocks: DataFrame) -> DataFrame:
    """Stored (word, c) of all training words; the end is one of them."""
    rows = blocks.select(F.explode(F.arrays_zip("words", "uses")).alias("w")).select("w.*").filter("uses > 0")
    return stored(rows.groupBy(F.col("words").alias("word")).agg(F.sum("uses").alias("c")), "words-counts")


class Vocabulary:
    """Totals, words that are classes of their own, and the tokens and words of each spelling class."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.tokens, self.words = int(total["n"]), int(total["v"])
        own = counts.filter(self.often()).select("word", "c").toArrow()  # at most OWN_SHARE rows
        order = np.argsort(own["word"].to_numpy())
        self.own, self.uses = own["word"].to_numpy()[order], own["c"].to_numpy()[order]
        kind = F.pmod("word", F.lit(SPELLINGS)).alias("spelling")
        rest = counts.filter(~self.often()).groupBy(kind).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toArrow()
        self.c, self.v = np.zeros(SPELLINGS, np.int64), np.zeros(SPELLINGS, np.int64)
        self.c[rest["spelling"].to_numpy()], self.v[rest["spelling"].to_numpy()] = rest["c"].to_numpy(), rest["v"].to_numpy()
        share = np.zeros(CLASSES)
        share[: len(self.own)] = self.uses + 1
        share[OWN_SHARE:] = self.c + self.v + 1
        self.share = share / share.sum()

    def often(self) -> Column:
        """Whether a counted word is a class of its own."""
        return F.col("c") * OWN_SHARE >= max(self.tokens, 1)

    def classes(self, words: np.ndarray) -> np.ndarray:
        """Class numbers: a place in ``own``, else OWN_SHARE plus the spelling class."""
        spellings = spelling(words)
        if not len(self.own):
            return OWN_SHARE + spellings
        at = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
        return np.where(self.own[at] == words, at, OWN_SHARE + spellings)


_CLASSED = "block bigint, keys binary, gone binary, held binary, sizes binary, known binary, base binary, inner binary, classes binary"
_CLASSED_SCHEMA = pa.schema([("block", pa.int64())] + [(c, pa.binary()) for c in ("keys", "gone", "held", "sizes", "known", "base", "inner", "classes")])


def class_tokens(blocks: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Stored blocks with a class for each token and, for each text, its known words, its
    base score and the log10 of what its classes give to its words."""
    place = F.shiftleft("block", PLACE_BITS) + F.col("place")
    asked = blocks.select("block", F.posexplode("words").alias("place", "word")).select("word", place.alias("at"))
    reply = F.shiftleft(F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)), COUNT_BITS) + F.col("c")
    own = counts.filter(vocabulary.often()).select("word").hint("broadcast")  # at most OWN_SHARE rows: the blocks know them
    told = asked.join(own, "word", "left_anti").join(counts.filter(~vocabulary.often()), "word").select(F.shiftright("at", PLACE_BITS).alias("block"), reply.alias("reply"))
    back = told.groupBy("block").agg(F.collect_list("reply").alias("found"))  # a block's own words: bounded like it
    model = blocks.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                voc = model.value
                words = row["words"].values.to_numpy()
                c = np.zeros(len(words), np.int64)
                if row["found"].is_valid:
                    replies = row["found"].values.to_numpy()
                    c[replies >> COUNT_BITS] = replies & ((1 << COUNT_BITS) - 1)
                classes = voc.classes(words)
                own = classes < OWN_SHARE
                c[own] = voc.uses[classes[own]]
                spelled = classes >= OWN_SHARE
                inner, kinds = np.zeros(len(words)), classes[spelled] - OWN_SHARE
                inner[spelled] = np.log10(c[spelled] + 1) - np.log10(voc.c[kinds] + voc.v[kinds] + 1)
                base = np.log10(c + 1) - np.log10(voc.tokens + voc.words + 1)
                tokens = unsqueezed(row["tokens"].as_py())
                starts = np.cumsum(np.frombuffer(row["sizes"].as_py(), "<i8"))
                starts = np.concatenate([[0], starts[:-1]])
                sums = [np.add.reduceat(v[tokens], starts) for v in ((c > 0).astype(np.int64), base, inner)]
                values = [row[n].as_py() for n in ("keys", "gone", "held", "sizes")] + [v.tobytes() for v in sums] + [squeezed(classes[tokens])]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"].as_py()])] + [pa.array([v], pa.binary()) for v in values], schema=_CLASSED_SCHEMA)

    return stored(blocks.drop("uses").join(back, "block", "left").mapInArrow(trimmed(run), _CLASSED), "words-classes")


# --- the model and its recursions ------------------------------------------------------------


class Model:
    """``first`` (states of a first token), ``move`` (state to state), ``emit`` (class x state)."""

    def __init__(self, first: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.first, self.move, self.emit = first, move, emit

    @classmethod
    def from_counts(cls, first: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
        """Smoothed probabilities from expected counts."""
        k = len(first)
        emit = (emit + SHARE_WEIGHT * share[:, None]) / (emit.sum(axis=0) + SHARE_WEIGHT)
        move = (move + EVEN_WEIGHT / k) / (move.sum(axis=1, keepdims=True) + EVEN_WEIGHT)
        return cls((first + EVEN_WEIGHT / k) / (first.sum() + EVEN_WEIGHT), move, emit)

    def log10_likelihood(self, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 probability of each of the sequences that stand one after another in ``classes``."""
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        out = np.zeros(len(sizes))
        usual = np.flatnonzero(sizes <= LONG)
        out[usual] = self._together(classes, starts[usual], sizes[usual])
        for i in np.flatnonzero(sizes > LONG).tolist():
            out[i] = self._chained(classes[starts[i] : starts[i] + sizes[i]])
        return out

    def _together(self, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        order = np.argsort(-sizes, kind="stable")
        at, sizes = starts[order], sizes[order]
        left = np.searchsorted(-sizes, -np.arange(1, sizes.max(initial=0) + 1), side="right")  # sequences with a t-th token
        total, state, ones = np.zeros(len(sizes)), np.zeros((0, len(self.first))), np.ones(len(self.first))
        left = left.tolist()
        for t, n in enumerate(left):
            ended = state[n:]
            total[n : n + len(ended)] += np.log10(ended @ ones)
            ahead = state[:n] @ self.move if t else np.broadcast_to(self.first, (n, len(self.first)))
            state = ahead * self.emit[classes[at[:n] + t]]
            if t % SCALE_EVERY == SCALE_EVERY - 1:
                scale = state @ ones
                state /= scale[:, None]
                total[:n] += np.log10(scale)
        total[: len(state)] += np.log10(state @ ones)
        out = np.zeros(len(sizes))
        out[order] = total
        return out

    def _chained(self, classes: np.ndarray) -> float:
        """Forward through a long sequence: stretches from every state at once, then one after another."""
        k, total, state = len(self.first), 0.0, None
        for a in range(0, len(classes), 256 * STRETCH):
            part = classes[a : a + 256 * STRETCH]
            begins = np.arange(0, len(part), STRETCH)
            sizes = np.minimum(STRETCH, len(part) - begins)
            path, logs = np.broadcast_to(np.eye(k), (len(begins), k, k)), np.zeros(len(begins))
            for t in range(int(sizes[0])):
                n = int((sizes > t).sum())
                entered = a + begins[0] + t == 0  # the text's very first token
                step = (path[:n].reshape(n * k, k) @ self.move).reshape(n, k, k)
                if entered:
                    step = np.concatenate([np.broadcast_to(self.first, (1, k, k)), step[1:]])
                step = step * self.emit[classes[a + begins[:n] + t]][:, None, :]
                scale = step.sum(axis=(1, 2))
                path = np.concatenate([step / scale[:, None, None], path[n:]])
                logs[:n] += np.log10(scale)
            for matrix, log in zip(path, logs):
                state = matrix[0] if state is None else state @ matrix
                scale = state.sum()
                state, total = state / scale, total + log + np.log10(scale)
        return float(total)

    def expected(self, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, opening: np.ndarray, sums: list[np.ndarray]) -> float:
        """Add the expected counts of some pieces (at most PIECE tokens each) to ``sums``: first, move, emit.

        ``opening``: which pieces begin a text; the others begin in a state that
        is drawn from ``first`` too, but do not count for it. Returns their log10 likelihood.
        """
        order = np.argsort(-sizes, kind="stable")
        at, sizes, opening = starts[order], sizes[order], opening[order]
        left = np.searchsorted(-sizes, -np.arange(1, sizes.max(initial=0) + 1), side="right").tolist()
        k, likelihood = len(self.first), 0.0
        ones, ahead, gave, scales = np.ones(k), [], [], {}
        for t, n in enumerate(left):
            gave.append(self.emit[classes[at[:n] + t]])
            state = (ahead[-1][:n] @ self.move if t else self.first) * gave[-1]
            if t % SCALE_EVERY == SCALE_EVERY - 1:
                scales[t] = (state @ ones)[:, None]
                state /= scales[t]
                likelihood += float(np.log10(scales[t]).sum())
            ahead.append(state)
        moved, posts = np.zeros((k, k)), [np.zeros((0, k))] * len(left)
        behind = np.zeros((0, k))
        for t in range(len(left) - 1, -1, -1):
            n, m = left[t], len(behind)
            rest = np.empty((n, k))
            if m:
                next_ = behind * gave[t + 1]
                if t + 1 in scales:
                    next_ /= scales[t + 1]
                moved += ahead[t][:m].T @ next_
                rest[:m] = next_ @ self.move.T
            last = ahead[t][m:] @ ones  # sequences that end here
            likelihood += float(np.log10(last).sum())
            rest[m:] = (1 / last)[:, None]
            behind = rest
            posts[t] = ahead[t] * behind
        sums[0] += posts[0][opening].sum(axis=0) if left else 0
        sums[1] += moved * self.move
        every = np.concatenate(posts).T.copy() if left else np.zeros((k, 0))
        names = np.concatenate([classes[at[:n] + t] for t, n in enumerate(left)]) if left else np.zeros(0, np.int64)
        for s in range(k):
            sums[2][:, s] += np.bincount(names, weights=every[s], minlength=CLASSES)
        return likelihood


def pieces_of(sizes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, opens a text) of the pieces of the wanted sequences."""
    count = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(sizes)), count)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = (np.cumsum(sizes) - sizes)[owner] + rank * PIECE
    keep = wanted[owner]
    return start[keep], np.minimum(PIECE, sizes[owner] - rank * PIECE)[keep], (rank == 0)[keep]


def _block_arrays(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    get = lambda c, t: np.frombuffer(batch.column(c)[i].as_py(), t)
    return unsqueezed(batch.column("classes")[i].as_py()).astype(np.int32), get("sizes", "<i8"), get("held", bool)


def draw_pieces(classed: DataFrame, tokens: int) -> DataFrame:
    """Up to START_PIECES rows (rank, opens, classes) of training pieces, drawn by a hash of what they hold."""
    wanted = int(min(1.0, 4 * START_PIECES * PIECE / max(tokens, 1)) * (2**32 - 1))

    def draw(batches):
        powers = mix64(np.arange(1, PIECE + 1, dtype=np.uint64))
        for batch in batches:
            for i in range(batch.num_rows):
                classes, sizes, held = _block_arrays(batch, i)
                start, size, opens = pieces_of(sizes, ~held)
                if not len(start):
                    continue
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                each = mix64(classes[np.repeat(start, size) + place].astype(np.uint64) + powers[place])
                rank = mix64(np.add.reduceat(each, np.cumsum(size) - size))
                low = np.flatnonzero(rank >> np.uint64(32) <= np.uint64(wanted))
                low = low[np.argsort(rank[low])][:START_PIECES]
                rows = [classes[start[j] : start[j] + size[j]].astype("<u2").tobytes() for j in low]
                yield pa.RecordBatch.from_arrays([pa.array(rank[low].view(np.int64)), pa.array(opens[low]), pa.array(rows, pa.binary())], names=["rank", "opens", "classes"])

    rows = classed.select("classes", "sizes", "held").mapInArrow(trimmed(draw), "rank bigint, opens boolean, classes binary")
    return rows.dropDuplicates(["rank"]).orderBy("rank").limit(START_PIECES)


def begin(pieces: list[np.ndarray], opens: np.ndarray, share: np.ndarray, states: int) -> list[np.ndarray]:
    """Expected counts to begin with: pieces fall into groups by their frequent classes, and Baum-Welch on them starts there."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    classes, starts = np.concatenate(pieces).astype(np.int32), np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(pieces)), sizes)
    often = np.argsort(-np.bincount(classes, minlength=CLASSES), kind="stable")[:512]
    column = np.full(CLASSES, -1)
    column[often] = np.arange(len(often))
    hit = column[classes] >= 0
    table_ = np.zeros((len(pieces), 512))
    np.add.at(table_, (owner[hit], column[classes[hit]]), 1.0)
    table_ = np.sqrt(table_)
    table_ /= np.maximum(np.linalg.norm(table_, axis=1, keepdims=True), 1e-12)
    centres = [table_[np.argmax(sizes)]]  # each next one is the piece least like all before
    for _ in range(states - 1):
        centres.append(table_[np.argmin(np.max(table_ @ np.array(centres).T, axis=1))])
    centres = np.array(centres)
    for _ in range(10):
        group = np.argmax(table_ @ centres.T, axis=1)
        for g in range(states):
            if (group == g).any():
                centres[g] = table_[group == g].sum(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    emit = np.zeros((CLASSES, states))
    np.add.at(emit, (classes, group[owner]), 1.0)
    n = emit.sum(axis=0)
    emit += emit.sum(axis=1, keepdims=True) * 0.05 / states
    sums = [n / n.sum(), np.diag(n) * 0.9 + np.outer(n, n) / max(n.sum(), 1) * 0.1, emit]
    for _ in range(START_ROUNDS):
        model, sums = Model.from_counts(*sums, share), [np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states))]
        model.expected(classes, starts, sizes, opens, sums)
    return sums


_SUMS = "name int, " + ", ".join(f"s{i} float" for i in range(STATES))


def _sum_rows(sums: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (name, one value per state): classes, then -1 - state for moves, then -1 - states for first states."""
    states = len(sums[0])
    used = np.flatnonzero(sums[2].any(axis=1))
    rows = np.concatenate([sums[2][used], sums[1], sums[0][None, :]])
    names = np.concatenate([used, -1 - np.arange(states), [-1 - states]]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(names)] + [pa.array(rows[:, s].astype(np.float32)) for s in range(states)], names=["name", *(f"s{i}" for i in range(states))])


def _read_sums(rows: DataFrame) -> list[np.ndarray]:
    """Sums over all tasks; at most CLASSES + STATES + 1 rows."""
    found = rows.groupBy("name").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(STATES)]).toArrow()
    names = found["name"].to_numpy()
    values = np.stack([found[f"s{i}"].to_numpy() for i in range(STATES)], axis=1) if len(names) else np.zeros((0, STATES))
    sums = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))]
    sums[2][names[names >= 0]] = values[names >= 0]
    at = -1 - names[names < 0]
    for i, v in zip(at.tolist(), values[names < 0]):
        if i < STATES:
            sums[1][i] = v
        else:
            sums[0] = v
    return sums


def train(classed: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training pieces, one Spark job a round."""
    spark, share = classed.sparkSession, vocabulary.share

    def start(batches):
        rows = [(o, np.frombuffer(c, "<u2")) for b in batches for o, c in zip(b.column("opens").to_pylist(), b.column("classes").to_pylist())]
        if rows:
            yield _sum_rows(begin([c for _, c in rows], np.array([o for o, _ in rows]), share, STATES))

    sums = _read_sums(draw_pieces(classed, vocabulary.tokens).coalesce(1).mapInArrow(start, _SUMS))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(Model.from_counts(*sums, share))

        def expect(batches, model=model):
            sums = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))]
            for batch in batches:
                for i in range(batch.num_rows):
                    classes, sizes, held = _block_arrays(batch, i)
                    start, size, opens = pieces_of(sizes, ~held)
                    order = np.argsort(-size, kind="stable")  # like sizes go together
                    for at in range(0, len(order), TOGETHER):
                        part = order[at : at + TOGETHER]
                        model.value.expected(classes, start[part], size[part], opens[part], sums)
            if sums[2].any():
                yield _sum_rows(sums)

        sums = _read_sums(classed.select("classes", "sizes", "held").mapInArrow(trimmed(expect), _SUMS))
        model.destroy()
    return Model.from_counts(*sums, share)


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Every row's scores: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end alone; one with over 2 ** 24 different words raises ValueError. A null id is learned from. Repeated
    rows are learned from and scored as often as they occur. Nothing to learn
    from: every token is unknown, base_score 0 and score that of even states.
    Words are named by 64-bit hashes: among n different ones the chance of any
    clash is about n * n / 2 ** 65. Other columns are ignored.
    """
    spark = docs.sparkSession
    blocks = number_words(docs, key, text)
    counts = count_words(blocks)
    vocabulary = Vocabulary(counts)
    classed = class_tokens(blocks, counts, vocabulary)
    model = spark.sparkContext.broadcast(train(classed, vocabulary, rounds))
    total = vocabulary.tokens
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_())] + [(c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")]
        + [("base_score", pa.float64()), ("score", pa.float64())]
    )

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                classes, sizes, held = _block_arrays(batch, i)
                get = lambda c, t: np.frombuffer(batch.column(c)[i].as_py(), t)  # noqa: B023, E731
                keys = pa.array(get("keys", "<i8"), mask=get("gone", bool))
                likely = model.value.log10_likelihood(classes, sizes) + get("inner", "<f8")
                columns = [keys, pa.array(held), pa.array(sizes), pa.array(get("known", "<i8")), pa.array(np.full(len(sizes), total)), pa.array(get("base", "<f8")), pa.array(likely)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return classed.mapInArrow(trimmed(score), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op12_latent_word_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents under a hidden Markov model and the add-one base."""
    return score_texts(table(spark, sf_dir, "documents"))
