"""Helpers shared by the operators: tables, Arrow batches, tokenizers, hashing."""

from __future__ import annotations

import os
import string
import sys
import types
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.fixtures import load_table
from vistra.session import scratch_path

# Rows and bytes of one Arrow batch. A Python worker holds a few batches at a
# time, so these two bound its memory whatever the partition holds (a single
# row larger than the byte bound travels alone).
BATCH_ROWS = 2500
BATCH_BYTES = 8 * 1024 * 1024


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return load_table(spark, sf_dir, name)


# Spark's setting (from 4.1 on) that an execution's shuffle files go when it ends;
# else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Executions within leave no shuffle files. For frames that are executed once."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not the work before.
    The shuffle files of that work go with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    found = spark.read.parquet(path)
    found._stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def draw_rows(df: DataFrame, n: int, *by: str) -> list:
    """Up to ``n`` rows of ``df``, drawn by a hash of the columns ``by``, whatever files or tasks hold them.

    ``by`` should tell rows apart (an id among them): rows that agree in it are drawn
    together. A threshold on the hash leaves about 4 n rows first, so that
    what reaches the driver does not grow with the number of tasks.
    """
    total = df.count()
    hashed = df.withColumn("_draw", F.xxhash64(*by))
    if total > 4 * n:
        hashed = hashed.filter(F.pmod("_draw", F.lit(2**32)) < int(4 * n / total * 2**32))
    return hashed.orderBy("_draw", *by).limit(n).collect()


def process_value(key, make):
    """``make()``, once in each Python worker process.

    Functions travel by value, so a module-level variable would be new in each
    task; this store belongs to the process and serves all its tasks.
    """
    store = sys.modules.setdefault("_vistra_process", types.ModuleType("_vistra_process")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def forget_values(kind: str) -> None:
    """Drop what ``process_value`` keeps under keys (``kind``, ...)."""
    store = sys.modules.get("_vistra_process", types.ModuleType("")).__dict__
    for key in [k for k in store if isinstance(k, tuple) and k[0] == kind]:
        del store[key]


def trimmed(function):
    """``function`` for mapInArrow; when a task ends, its worker gives free memory back.

    Workers serve many tasks of many queries, and allocators keep what one of them
    needed at its peak. Tables that take milliseconds to make go too.
    """

    def run(batches):
        import ctypes
        import gc

        yield from function(batches)
        forget_values("powers")
        gc.collect()
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)

    return run


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts; a null text counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


# Texts are worked through some so many bytes at a time; a longer one alone.
GROUP_BYTES = 1 << 19


def text_groups(batch: pa.RecordBatch, column: str = "text", size: int = GROUP_BYTES):
    """``texts_of`` in runs of some ``size`` bytes: (first row, texts).

    Splitting and hashing take many times a text's bytes, so a batch is worked
    through in such runs; a run is less than ``size`` and one text.
    """
    texts = batch.column(column)
    before = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    group = np.concatenate([[0], before[:-1]]) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)] if len(texts) else []
    for a, b in zip(cuts, cuts[1:]):
        yield a, [t or "" for t in texts.slice(a, b - a).to_pylist()]


# --- tokenizers -----------------------------------------------------------------


def tokenizer_path(name: str) -> str:
    """A file's place: an absolute path as it is, else a public vocabulary's name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(name: str):
    """The tokenizers library's tokenizer for a file, once per worker process."""

    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(tokenizer_path(name))

    return process_value(("tokenizer", name), make)


# Words whose tokens a worker keeps; beyond that, the half of them that most batches held.
WORD_CACHE = 500_000
# Longer words, in bytes, are kept for one batch only.
WORD_BYTES = 40
# Words the library encodes in one call: it keeps some 100 bytes a token until it returns.
LEARN_WORDS = 20_000
# Letters for which lower-casing and composition concern one character alone
# and agree between libraries: ASCII and Latin letters up to U+017F but U+0130.
SIMPLE_WORD = "^[a-zA-ZÀ-ÖØ-öø-ÿĀ-įı-ſ]+$"
# After such letters, any run of these is a piece of its own.
PUNCTUATION = string.punctuation


def strings(column: pa.Array) -> list[str]:
    """A column without nulls as Python strings; some times faster than to_pylist()."""
    return column.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Token ids of whole texts for a tokenizer that never crosses ASCII white space.

    ``word_bpe_49k.json`` drops white space, and its normalisation, splitting
    and merges see one white-space-free run at a time; so a text's ids are
    those of its runs in order, and each distinct run is encoded once. A run of
    plain letters skips normalisation and splitting, which leave it whole and
    in lower case; ASCII punctuation after it is a word of its own. All ids
    come from the tokenizers library. Known words and their ids are two columns
    that are looked up and joined a batch at a time.
    """

    def __init__(self, name: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = load_tokenizer(name)
        self.plain = Tokenizer.from_file(tokenizer_path(name))
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.full.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 65536 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.words, self.ids, self.uses = pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros(0, np.int64)

    def _keep(self, most: int) -> None:
        """Keep short words alone; of more than ``most``, those that most batches held, late ones first."""
        kept = np.flatnonzero(pc.binary_length(self.words).to_numpy() <= WORD_BYTES)
        if len(kept) > most:
            kept = np.sort(kept[np.argsort(self.uses[kept], kind="stable")[-most:]])
            self.uses //= 2
        if len(kept) < len(self.words):
            self.words, self.ids, self.uses = self.words.take(pa.array(kept)), self.ids.take(pa.array(kept)), self.uses[kept]

    def forget(self) -> None:
        """Drop the words a task has learned but for some 50,000, for a next task to begin with."""
        self._keep(50_000)

    def _plain(self, words: list[str]) -> pa.Array:
        """Encode lower-case plain words in one call; an id that ends a word ends it."""
        ids = np.array(self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=self.dtype)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        offsets = (np.append(0, stops) * self.dtype.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])

    def _other(self, runs: list[str]) -> pa.Array:
        encoded = []
        for i in range(0, len(runs), 1000):
            encoded += [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.full.encode_batch_fast(runs[i : i + 1000], add_special_tokens=False)]
        return pa.array(encoded, pa.binary())

    def _learn(self, words: pa.Array, encode) -> None:
        parts = [words.slice(i, LEARN_WORDS) for i in range(0, len(words), LEARN_WORDS)]
        self.ids = pa.concat_arrays([self.ids, *(encode(strings(p)) for p in parts)])
        self.words = pa.concat_arrays([self.words, words])
        self.uses = np.append(self.uses, np.zeros(len(words), np.int64))

    def _places(self, words: pa.Array) -> pa.Array:
        """Where each of the words stands among the known ones; new ones are learned, plain ones by the short way."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        found = pc.index_in(self.words, value_set=distinct)  # the batch's words make the hash table
        place = np.full(len(distinct), -1)
        place[pc.drop_null(found).to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        new = np.flatnonzero(place < 0)
        plain = pc.match_substring_regex(distinct.take(pa.array(new)), SIMPLE_WORD).to_numpy(zero_copy_only=False)
        for at, encode in ((new[plain], self._plain), (new[~plain], self._other)):
            place[at] = len(self.words) + np.arange(len(at))
            self._learn(distinct.take(pa.array(at)), encode)
        self.uses[place] += 1
        return pa.array(place).take(coded.indices)

    def _ids_of(self, runs: pa.Array) -> pa.Array:
        """The ids of distinct runs: letters with punctuation after them as word and tail, the rest whole."""
        stems = pc.utf8_rtrim(runs, PUNCTUATION)
        simple = pc.match_substring_regex(stems, SIMPLE_WORD)
        tailed = pc.and_(simple, pc.less(pc.binary_length(stems), pc.binary_length(runs)))
        tails = pc.replace_substring_regex(pc.filter(runs, tailed), SIMPLE_WORD[:-1], "")
        words = pc.if_else(simple, pc.utf8_lower(stems), runs)
        at = self._places(pa.concat_arrays([words, tails]))
        ids = self.ids.take(at.slice(0, len(runs)))
        if not len(tails):
            return ids
        whole = pc.binary_join_element_wise(pc.filter(ids, tailed), self.ids.take(at.slice(len(runs))), pa.scalar(b"", pa.binary()))
        return pc.replace_with_mask(ids, tailed, whole)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Each text's ids as little-endian bytes of ``self.dtype``; a null in a column is empty."""
        if not len(texts):
            return []
        column = pc.fill_null(texts, "") if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        lists = pc.ascii_split_whitespace(column)
        runs, offsets = lists.flatten().dictionary_encode(), lists.offsets
        del column, lists  # as large as the texts
        found = self._ids_of(runs.dictionary).take(runs.indices)
        self._keep(WORD_CACHE // 2 if len(self.words) > WORD_CACHE else WORD_CACHE)
        # the ids of all texts lie one after another in the taken array's buffer
        at = np.frombuffer(found.buffers()[1], dtype=np.int32, count=len(found) + 1, offset=4 * found.offset)
        data = memoryview(found.buffers()[2]) if found.buffers()[2] is not None else b""
        cuts = at[offsets.to_numpy() - offsets[0].as_py()].tolist()
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]


def word_encoder(name: str) -> WordEncoder:
    return process_value(("words", name), lambda: WordEncoder(name))


# --- words and their hashes --------------------------------------------------------

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; those of usual length are kept until the task ends."""

    def make(size):
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    size = 2 * GROUP_BYTES
    return process_value(("powers", base), lambda: make(size))[:n] if n <= size else make(n)


def in_groups(texts: list[str], size: int = GROUP_BYTES):
    """``texts`` in runs of at least about ``size`` characters."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts, hashed to 64 bits.

    ``hash``: one value per word, in order; ``first``: index of each text's
    first word, with one more entry at the end. ``buf``, ``start`` and ``stop``
    give the bytes. A 64-bit hash stands for a word; the chance of any clash
    among n different words is about n * n / 2 ** 65.
    """

    def __init__(self, texts: list[str], lower: bool = False):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
        buf = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8) if raw else np.zeros(0, np.uint8)
        if lower:
            buf = _LOWER[buf]
        self.buf, self.text_at = buf, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        space = _SPACE[buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(buf) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.stop = edge[0::2], edge[1::2]
        # Horner's sums by running totals: powers of an odd base are invertible modulo 2^64
        inverse = pow(_BASE, -1, 1 << 64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE_CODE[buf] * _powers(len(buf), _BASE), dtype=np.uint64)])
        span = total[self.stop] - total[self.start]
        self.hash = mix64(span * _powers(len(buf) + 1, inverse)[self.start] + (self.stop - self.start).astype(np.uint64))
        self.first = np.searchsorted(self.start, self.text_at)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words within a text: (hash, word index, text index)."""
        count = np.diff(self.first)
        if len(self.hash) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        acc = np.zeros(len(self.hash) - n + 1, dtype=np.uint64)
        for k in range(n):
            acc = mix64(acc + self.hash[k : k + len(acc)] + np.uint64(k + 1))
        text = np.repeat(np.arange(len(count)), np.maximum(count - n + 1, 0))
        rank = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(np.maximum(count - n + 1, 0))])[:-1], np.maximum(count - n + 1, 0))
        at = self.first[text] + rank
        return acc[at], at, text
