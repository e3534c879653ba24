"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Every run of ``n`` words of a benchmark item is looked for in every whole text;
where some occur, the passage around them is kept. Each of them is a seed: a
choice per item, by rarity say, would leave out the n-grams that some edited
copy has kept. Seeds join passages to items, and a local alignment of words
scores each pair, so that edited copies count by what is left of them. A
passage meets an item only if it has words enough of it for the least score:
an alignment matches no more words than both have in common, so this loses no
pair, and a common n-gram by itself makes none.

Words are runs of non-blank characters in lower case without punctuation at
their ends. Alignment: 2 for a word in common, -1 for another word or a gap;
a pair's score is its best sum over the sum of a whole copy of the item.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import mix64, stored, table, text_groups, trimmed

SEED_WORDS = 3
LEAST_SCORE = 0.5
MATCH, OTHER, GAP = 2, -1, -1
# The benchmark is worked through in blocks of about so many characters; one
# block's words and n-grams go to every task (some 10 times that many bytes).
BLOCK_CHARS = 2_000_000
_EDGE = ".,;:!?\"'()[]{}<>«»“”„‘’¿¡-–—*_`|"


class WordCodes:
    """Numbers for a block's words; words of a text that no item has are 0."""

    def __init__(self, items: list[str]):
        words = [self.words(t) for t in items]
        self.code: dict[str, int] = {}
        for w in words:
            for x in w:
                self.code.setdefault(x, len(self.code) + 1)
        self.items = [np.array([self.code[x] for x in w], dtype=np.int32) for w in words]

    @staticmethod
    def words(text: str) -> list[str]:
        return [x for x in (w.lower().strip(_EDGE) for w in text.split()) if x]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(codes of all texts' words in order, index of each text's first word and an end)."""
        lists = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
        runs = lists.flatten().dictionary_encode()
        names = runs.dictionary.to_numpy(zero_copy_only=False).tolist()
        stripped = [r.lower().strip(_EDGE) for r in names]
        get = self.code.get
        codes = np.array([get(r, 0) if r else -1 for r in stripped], dtype=np.int32)
        every = codes[runs.indices.to_numpy()] if len(names) else np.zeros(0, np.int32)
        at = lists.offsets.to_numpy()
        real = every >= 0  # runs of punctuation alone are no words
        return every[real], np.concatenate([[0], np.cumsum(real)])[at - at[0]]


class SeedIndex:
    """A block's n-grams with the items that hold them, and each item's words with their counts."""

    def __init__(self, items: list[np.ndarray], n: int):
        grams = [np.unique(gram_hashes(x, n)) for x in items]
        every = np.concatenate(grams) if grams else np.zeros(0, np.int64)
        holder = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.holders, self.holder_at = holder[order].astype(np.int32), np.append(first, len(every))
        words = [np.unique(x, return_counts=True) for x in items]
        self.words = np.concatenate([w for w, _ in words]) if words else np.zeros(0, np.int32)
        self.counts = np.concatenate([c for _, c in words]) if words else np.zeros(0, np.int64)
        self.word_at = np.concatenate([[0], np.cumsum([len(w) for w, _ in words])]).astype(np.int64)
        self.length = np.array([len(x) for x in items], dtype=np.int64)

    def items_of(self, grams: np.ndarray, codes: np.ndarray, least: float) -> np.ndarray:
        """Items that hold one of ``grams`` and share words enough with ``codes`` for a score of ``least``."""
        at = np.searchsorted(self.grams, grams)
        items = np.unique(self.holders[ranges(self.holder_at[at], self.holder_at[at + 1])])
        own, have = np.unique(codes, return_counts=True)
        size = self.word_at[items + 1] - self.word_at[items]
        entry = ranges(self.word_at[items], self.word_at[items + 1])
        word = self.words[entry]
        near = np.minimum(np.searchsorted(own, word), len(own) - 1)
        shared = np.add.reduceat(np.where(own[near] == word, np.minimum(have[near], self.counts[entry]), 0), np.cumsum(size) - size)
        return items[MATCH * shared / (MATCH * self.length[items]) >= least]


def ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [first, end), one range after another."""
    size = end - first
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` codes (signed)."""
    if len(codes) < n:
        return np.zeros(0, np.int64)
    acc = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for k in range(n):
        acc = mix64(acc + codes[k : k + len(acc)].astype(np.uint64) + np.uint64(k << 33))
    return acc.view(np.int64)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair: (sum, last item word, last passage word).

    All pairs at once, a row of the Smith-Waterman table for an item word at a
    time; gaps along a row by a running maximum.
    """
    count, m, w = len(items), max(map(len, items)), max(map(len, passages))
    item = np.full((count, m), -1, dtype=np.int32)
    passage = np.full((count, w), -2, dtype=np.int32)
    for i, (x, p) in enumerate(zip(items, passages, strict=True)):
        item[i, : len(x)], passage[i, : len(p)] = x, p
    steps = np.arange(w, dtype=np.int32) * -GAP
    before = np.zeros((count, w + 1), dtype=np.int32)
    best, last_item, last_word = np.zeros(count, np.int32), np.zeros(count, np.int64), np.zeros(count, np.int64)
    for i in range(m):
        here = np.maximum(before[:, :-1] + np.where(passage == item[:, i : i + 1], MATCH, OTHER), before[:, 1:] + GAP)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + steps, axis=1) - steps
        at = here.argmax(axis=1)
        top = here[np.arange(count), at]
        better = top > best
        best[better], last_item[better], last_word[better] = top[better], i, at[better]
        before[:, 1:] = here
    return best, last_item, last_word


def align_spans(items: list[np.ndarray], passages: list[np.ndarray], least: float) -> list[tuple[float, int, int]]:
    """(score, first passage word, end) of each pair; (score, 0, 0) below ``least``."""
    out: list[tuple[float, int, int]] = [(0.0, 0, 0)] * len(items)
    order = sorted(range(len(items)), key=lambda i: (len(passages[i]), len(items[i])))
    at = 0
    while at < len(order):
        part = order[at : at + max(1, min(256, 2_000_000 // max(1, len(passages[order[min(at + 255, len(order) - 1)]]))))]
        at += len(part)
        best, last_item, last_word = align([items[i] for i in part], [passages[i] for i in part])
        scores = best / np.array([MATCH * len(items[i]) for i in part])
        hits = [k for k in range(len(part)) if scores[k] >= least]
        for k, i in enumerate(part):
            out[i] = (float(scores[k]), 0, 0)
        if hits:
            # the same alignment from its end backwards gives its start
            cut = [(items[part[k]][: last_item[k] + 1][::-1], passages[part[k]][: last_word[k] + 1][::-1]) for k in hits]
            _, _, first = align([c[0] for c in cut], [c[1] for c in cut])
            for k, f in zip(hits, first.tolist()):
                end = int(last_word[k]) + 1
                out[part[k]] = (float(scores[k]), end - 1 - f, end)
    return out


def seeded(batch: pa.RecordBatch, known: WordCodes, index: SeedIndex, n: int, least: float, reach: int):
    """(row in the batch, text_hash, first_word, codes, items) of a batch's passages, see ``passages``."""
    sought = index.grams
    if not len(sought):
        return
    for begin, texts in text_groups(batch, "_text"):
        every, at = known.encode(texts)
        if len(every) < n:
            continue
        usable = np.ones(len(every) - n + 1, dtype=bool)
        for k in range(n):
            usable &= every[k : k + len(usable)] > 0
        start = np.flatnonzero(usable)
        value = gram_hashes_at(every, start, n)
        hit = sought[np.minimum(np.searchsorted(sought, value), len(sought) - 1)] == value
        start, value = start[hit], value[hit]
        doc = np.searchsorted(at, start, side="right") - 1
        inside = start + n <= at[doc + 1]
        start, value, doc = start[inside], value[inside], doc[inside]
        if not len(start):
            continue
        cut = np.flatnonzero((doc[1:] != doc[:-1]) | (start[1:] - start[:-1] > 2 * reach)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(start)]):
            d = int(doc[a])
            first = max(int(at[d]), int(start[a]) - reach)
            last = min(int(at[d + 1]), int(start[b - 1]) + n + reach)
            items = index.items_of(np.unique(value[a:b]), every[first:last], least)
            if len(items):
                # copied: a slice would hold the words of its whole run
                yield begin + d, batch.column("text_hash")[begin + d].as_py(), first - int(at[d]), every[first:last].copy(), items


def passages(docs: DataFrame, codes: WordCodes, n: int, least: float, key: str, text: str) -> DataFrame:
    """Stored (passage, row, _key, text_hash, first_word, codes, items) around all benchmark n-grams.

    Hits nearer to each other than two items' length share a passage, which
    reaches one item's length beyond its first and last hit. ``items``: those
    that a seed joins to it (see ``SeedIndex.items_of``); passages without any
    are left out.
    """
    reach = max([len(x) for x in codes.items], default=0)
    shared = docs.sparkSession.sparkContext.broadcast((codes, SeedIndex(codes.items, n)))
    schema = pa.schema(
        [("passage", pa.int64()), ("row", pa.int64()), ("_key", pa.int64()), ("text_hash", pa.int64()), ("first_word", pa.int64()), ("codes", pa.list_(pa.int32())), ("items", pa.list_(pa.int32()))]
    )

    def find(batches):
        from pyspark import TaskContext

        known, index = shared.value
        number = row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for d, hash_of, first, words, items in seeded(batch, known, index, n, least, reach):
                out.append((number, row + d, batch.column("_key")[d].as_py(), hash_of, first, words, items))
                number += 1
            row += batch.num_rows
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    source = docs.select(F.col(key).cast("bigint").alias("_key"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("_text"))
    ddl = "passage bigint, row bigint, _key bigint, text_hash bigint, first_word bigint, codes array<int>, items array<int>"
    found = stored(source.mapInArrow(trimmed(find), ddl), "leak-passages")
    shared.destroy()  # what it served is stored
    return found


def gram_hashes_at(codes: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    acc = np.zeros(len(start), dtype=np.uint64)
    for k in range(n):
        acc = mix64(acc + codes[start + k].astype(np.uint64) + np.uint64(k << 33))
    return acc.view(np.int64)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, n: int = SEED_WORDS, least: float = LEAST_SCORE, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """One row per row of ``docs`` and item it leaks: doc_id, text_hash, item_id, score, start_word, end_word.

    ``benchmark``: item_id, text. Items of fewer than ``n`` words match nothing;
    null texts are empty. Rows with equal or null ids are rows of their own;
    equal items each give a row. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    out = None
    for b in range(blocks):
        # about block_chars characters: a bounded share of the benchmark
        block = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]
        block = [r for r in block if len(WordCodes.words(r[1])) >= n]
        part = _leaks_of_block(spark, docs, block, n, least, key, text)
        out = part if out is None else out.unionByName(part)
    return out


def _leaks_of_block(spark, docs, block, n, least, key, text) -> DataFrame:
    codes = WordCodes([r[1] for r in block])
    pairs = passages(docs, codes, n, least, key, text).withColumn("item", F.explode("items")).drop("items").repartition("passage", "item")
    shared = spark.sparkContext.broadcast((codes.items, [r[0] for r in block]))
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("item", pa.int32()), ("score", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]
    )

    def score(batches):
        known, names = shared.value
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("row", "_key", "text_hash", "first_word", "item")}
            texts = [np.array(x.values.to_numpy(zero_copy_only=False), dtype=np.int32) for x in batch.column("codes")]
            spans = align_spans([known[i] for i in rows["item"]], texts, least)
            out = [
                (r, k, h, names[i], i, s, f + a, f + b)
                for r, k, h, f, i, (s, a, b) in zip(rows["row"], rows["_key"], rows["text_hash"], rows["first_word"], rows["item"], spans)
                if s >= least
            ]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    ddl = "row bigint, doc_id bigint, text_hash bigint, item_id bigint, item int, score double, start_word bigint, end_word bigint"
    scored = pairs.mapInArrow(trimmed(score), ddl)
    best = F.max(F.struct("score", (-F.col("start_word")).alias("back"), "end_word", "doc_id", "text_hash", "item_id")).alias("best")
    top = scored.groupBy("row", "item").agg(best)
    return top.select("best.doc_id", "best.text_hash", "best.item_id", "best.score", (-F.col("best.back")).alias("start_word"), "best.end_word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text leaks an item."""
    leaks = stored(find_leaks(docs, benchmark, text=text, **options).select("text_hash").distinct(), "leaks")
    return docs.withColumn("_hash", F.xxhash64(text)).join(leaks.withColumnRenamed("text_hash", "_hash"), "_hash", "left_anti").drop("_hash")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: (doc_id, item_id, score, start_word, end_word)."""
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "score", "start_word", "end_word")
