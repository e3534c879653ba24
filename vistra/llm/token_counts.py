"""Token counts of texts of any length by overlap resynchronisation.

A text longer than ``chunk`` characters is encoded in overlapping chunks with
offsets. Chunks are spliced at a proven boundary: a place where a pre-token
(the tokenizer's word, which merges never cross) starts in the left chunk and
in the right one. From such a place on the tokenizer sees the same characters
in the same state, so the right chunk's tokens are the whole text's tokens. The
left chunk's are so up to its last but one pre-token, since the last ones may
change with what follows. Where no common boundary lies in the overlap, the
left chunk is widened and encoded again, up to the end of the text.

A text or chunk is cut into pieces at white space (see ``PieceCounter``), and
each distinct piece is encoded once: most words recur. Piece starts are starts
of pre-tokens, so chunks are spliced at them; where two chunks share none, the
library encodes both whole, with the offsets of all its pre-tokens.
"""

from __future__ import annotations

import json
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import LEARN_WORDS, WORD_BYTES, WORD_CACHE, load_tokenizer, process_value, strings, table

CHUNK = 65_536
OVERLAP = 512
TOKEN_LIMIT = 512
# characters at a chunk's end whose tokens may still change: more than the
# longest special string, a contraction and one space of look-ahead
MARGIN = 64
# texts that the library encodes whole in one call
WHOLE_TEXTS = 100
# short texts cut into pieces at a time, which take some times their bytes
CUT_BYTES = 2 << 20

# White space as byte-level tokenizers split it (\s of their pattern; RE2's own is ASCII only).
_LINE = r"\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_MARK = "\x01"
# Where pieces begin: the last character of a run of white space goes with what
# follows if it is a blank, and stands alone otherwise.
_CUTS = ((f" [^ {_LINE}]", rf"{_MARK}\0"), (f"([{_LINE}])([^ {_LINE}{_MARK}])", rf"{_MARK}\1{_MARK}\2"))
_WORD = f"^ ?[^ {_LINE}]+$"
# Some letters and digits that every Unicode version counts as such.
_LETTER = "[0-9A-Za-zÀ-ÖØ-öø-ſΑ-ΡΣ-Ωα-ωЀ-ҁҊ-ԯ]"


def _words(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Starts (characters) of pre-tokens, and the tokens before each one and in all."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids], dtype=np.int64)
    starts = np.array([a for a, _ in encoding.offsets], dtype=np.int64)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (words[1:] < 0)]))
    return starts[first], np.append(first, len(words))


def _whole(encode_batch):
    """``splices``'s way to encode, from texts to encodings (with ids, offsets and word_ids)."""
    return lambda texts: [(e, *_words(e)) for e in encode_batch(texts)]


def splices(encoders: list, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[tuple]:
    """What ``text`` is put together from: (an encoding, how many of its first tokens), in order.

    ``encoders``: functions from texts to (encoding, starts of words, tokens
    before each word and in all); each is tried where those before it find no
    common boundary.
    """
    at, size = 0, chunk  # `at` is a proven boundary, so the chunk's start is right
    while at < len(text):
        if len(text) - at <= size + overlap:
            encoding, _, tokens = encoders[0]([text[at:]])[0]
            yield encoding, int(tokens[-1])
            return
        right_at = at + size
        for encode in encoders:
            (left, starts, tokens), (_, others, _) = encode([text[at : right_at + overlap], text[right_at : right_at + 2 * overlap]])
            sure = starts + at <= right_at + overlap - MARGIN
            if len(sure):
                sure[-2:] = False  # the last pre-tokens may go on or change
            common = np.flatnonzero(sure)[np.isin(starts[sure] + at, others + right_at)]
            if len(common):
                break
        if len(common):
            k = common[-1]
            yield left, int(tokens[k])
            at, size = int(starts[k]) + at, chunk
        else:
            size, overlap = size + overlap, overlap * 2


def spliced_ids(encode_batch, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
    """The ids of ``text`` in order, in runs; each from one chunk's encoding.

    ``encode_batch``: texts to encodings (with ids, offsets and word_ids).
    """
    for encoding, n in splices([_whole(encode_batch)], text, chunk, overlap):
        yield encoding.ids[:n]


class PieceCounter:
    r"""Numbers of tokens by distinct pieces, for a byte-level tokenizer.

    Its pattern (contractions, `` ?\p{L}+``, `` ?\p{N}+``, `` ?[^\s\p{L}\p{N}]+``,
    ``\s+(?!\S)``, ``\s+``) takes white space and other characters apart but for
    one blank before a word, and parts a run of white space before its last
    character if more text follows. So a text cut at these places has the tokens
    that its pieces have by themselves. ASCII punctuation that ends a piece after
    a letter or digit is a pre-token of its own. Texts with special strings or the
    mark of the cuts, and all texts for tokenizers of another kind, are encoded
    whole. All numbers come from the library.
    """

    def __init__(self, name: str):
        self.library = load_tokenizer(name)
        config = json.loads(self.library.to_str())
        split, added = config["pre_tokenizer"] or {}, config["added_tokens"]
        line = self.encode_batch(["\n"])[0].ids
        self.cuts = (
            split.get("type") == "ByteLevel"
            and split["use_regex"]
            and not split["add_prefix_space"]
            and config["model"]["type"] == "BPE"
            and not (config["normalizer"] or config["truncation"] or config["padding"] or config["model"]["dropout"])
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
            and len(line) == 1
        )
        vocab = self.library.get_vocab(with_added_tokens=True)
        # tokens that begin a word: a blank's (Ġ) its own, a line feed's one put before it
        self.blank, self.line = np.zeros((2, max(vocab.values(), default=0) + 1), dtype=bool)
        self.blank[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        self.line[line] = True
        self.uncut = "|".join(map(re.escape, [_MARK, *(t["content"] for t in added)]))
        self.known, self.older = {}, {}

    def encode_batch(self, texts: list[str]) -> list:
        return self.library.encode_batch(texts, add_special_tokens=False)

    def _whole_counts(self, texts: list[str]) -> list[int]:
        parts = (texts[i : i + WHOLE_TEXTS] for i in range(0, len(texts), WHOLE_TEXTS))
        return [len(e) for part in parts for e in self.library.encode_batch_fast(part, add_special_tokens=False)]

    def _word_counts(self, words: list[str], before: str, begins: np.ndarray) -> list[int]:
        """Encode words in one call, with ``before`` before each; ids of ``begins`` show where they begin.

        A word holds one such id at most; where a vocabulary has none for some word, each is encoded by itself.
        """
        ids = np.array(self.library.encode_batch_fast([before + before.join(words)], add_special_tokens=False)[0].ids)
        first = np.append(np.flatnonzero(begins[ids]), len(ids))
        if len(first) != len(words) + 1:
            return self._whole_counts(words)
        return (np.diff(first) - len(before)).tolist()

    def _learn(self, pieces: list[str]) -> None:
        column = pa.array(pieces, pa.string())
        word = pc.and_(pc.match_substring_regex(column, _WORD), pc.less_equal(pc.binary_length(column), WORD_BYTES))
        blank = pc.starts_with(column, " ")
        for mask, before, begins in ((pc.and_(word, blank), "", self.blank), (pc.and_not(word, blank), "\n", self.line)):
            words = strings(pc.filter(column, mask))
            for i in range(0, len(words), LEARN_WORDS):
                part = words[i : i + LEARN_WORDS]
                self.known.update(zip(part, self._word_counts(part, before, begins), strict=True))
        others = strings(pc.filter(column, pc.invert(word)))
        self.known.update(zip(others, self._whole_counts(others), strict=True))

    def _known_counts(self, pieces: pa.Array) -> np.ndarray:
        """Tokens of distinct pieces; new ones are learned, short ones kept while they recur."""
        words = strings(pieces)
        missing = [w for w in words if w not in self.known]
        self.known.update((w, self.older[w]) for w in missing if w in self.older)
        self._learn([w for w in missing if w not in self.older])
        counts = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        for w in missing:
            if len(w) > WORD_BYTES:
                del self.known[w]
        if len(self.known) > WORD_CACHE // 2:
            self.known, self.older = {}, self.known
        return counts

    def _piece_counts(self, pieces: pa.Array) -> np.ndarray:
        """Tokens of distinct pieces, their last punctuation counted apart."""
        stems = pc.utf8_rtrim(pieces, string.punctuation)
        tailed = pc.and_(pc.match_substring_regex(stems, f"{_LETTER}$"), pc.less(pc.binary_length(stems), pc.binary_length(pieces)))
        tails = pc.replace_substring_regex(pc.filter(pieces, tailed), f"^.*{_LETTER}", "")
        coded = pa.concat_arrays([pc.if_else(tailed, stems, pieces), tails]).dictionary_encode()
        counts = self._known_counts(coded.dictionary)[coded.indices.to_numpy()]
        out = counts[: len(pieces)]
        out[tailed.to_numpy(zero_copy_only=False)] += counts[len(pieces) :]
        return out

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(pieces of all texts, each text's first piece and the number of all, tokens of each)."""
        for pattern, cut in _CUTS:
            texts = pc.replace_substring_regex(texts, pattern, cut)
        lists = pc.split_pattern(texts, _MARK)
        pieces, first = lists.flatten(), lists.offsets.to_numpy()
        coded = pieces.dictionary_encode()
        return pieces, first - first[0], self._piece_counts(coded.dictionary)[coded.indices.to_numpy()]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a column without nulls."""
        whole = pc.match_substring_regex(texts, self.uncut).to_numpy(zero_copy_only=False) if self.cuts else np.ones(len(texts), bool)
        out = np.zeros(len(texts), np.int64)
        out[whole] = self._whole_counts(texts.filter(pa.array(whole)).to_pylist())
        if not whole.all():
            _, first, counts = self._cut(texts.filter(pa.array(~whole)))
            out[~whole] = np.diff(np.append(0, np.cumsum(counts))[first])
        return out

    def words(self, texts: list[str]) -> list[tuple]:
        """For ``splices``: (None, starts of pieces, tokens before each one and in all) of each text."""
        return [self._words_of(t) for t in texts]

    def _words_of(self, text: str) -> tuple:
        if re.search(self.uncut, text):
            return _whole(self.encode_batch)([text])[0]
        pieces, _, counts = self._cut(pa.array([text], pa.string()))
        ends = np.cumsum(pc.utf8_length(pieces).to_numpy())
        return None, np.append(0, ends[:-1]), np.append(0, np.cumsum(counts))

    def long_count(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of a text of any length, chunk by chunk."""
        whole = _whole(self.encode_batch)
        return sum(n for _, n in splices([self.words, whole] if self.cuts else [whole], text, chunk, overlap))


def count_tokens(texts: pa.Array, counter: PieceCounter, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    """Number of tokens of each text (null: empty); short texts some CUT_BYTES at a time, long ones spliced."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return np.zeros(0, np.int64)
    long = pc.greater(pc.utf8_length(texts), chunk)
    short = pc.if_else(long, "", texts)
    sizes = np.cumsum(pc.binary_length(short).to_numpy().astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(sizes // CUT_BYTES)) + 1).tolist(), len(texts)]
    counts = np.concatenate([counter.counts(short.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])
    for i in np.flatnonzero(long.to_numpy(zero_copy_only=False)):
        counts[i] = counter.long_count(texts[i].as_py(), chunk, overlap)
    return counts


def token_counts(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = TOKEN_LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; no shuffle.

    Null text: empty, 0 tokens. Null and repeated keys: one row each. Other
    columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches):
        counter = process_value(("pieces", tokenizer), lambda: PieceCounter(tokenizer))
        for batch in batches:
            texts = batch.column("_text")
            n = count_tokens(texts, counter, chunk, overlap)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_key"), sizes, pa.array(n), pa.array(n > limit)], schema=schema)

    source = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))
    return source.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents for byte_bpe_50k.json."""
    return token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")
