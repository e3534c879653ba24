"""Token-id files: a concatenated id array with Elias-Fano document boundaries.

File format. A file is a run of blocks, each followed by one line feed::

    magic "VTF1" | part u32 | block u32 | id bytes u8 | documents u32 | ids u64
    | Elias-Fano boundaries | Elias-Fano document keys | null flags | ids

``part`` orders the files and ``block`` the blocks within one. The boundaries
hold documents + 1 values (document i's ids are [b_i, b_i+1)); the keys hold the
document ids less the block's smallest. An Elias-Fano sequence of n values below
2^63 takes about 2 + log2(u / n) bits a value, against 64 in a plain table:
each value's low bits lie in a packed array, its high bits in unary, and a
sample of every 256th one bit lets select(i) jump to the right place.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistra.llm.common import table, word_encoder
from vistra.session import scratch_path

MAGIC = b"VTF1"
_HEAD = "<4sIIBIQ"
_EF = "<QQBII"
SAMPLE = 256  # one select sample per so many values
FILE_BYTES = 128_000_000  # text of one file
BLOCK_IDS = 1_000_000  # a block is closed once it holds so many ids
NULL_KEY = -(2**63)

# Ones of each byte, and where its i-th one stands.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(axis=1).astype(np.int64)
_PLACE = np.stack([np.append(np.flatnonzero(b), np.zeros(8 - b.sum(), np.int64)) for b in _BITS]).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of integers in [0, 2^63) in near-minimal space."""

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self._low, self._high, self._samples = low, high, np.frombuffer(samples, dtype="<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n, universe = len(v), int(v[-1]) + 1 if len(v) else 0
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little").tobytes() if bits else b""
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[ones] = 1
        return cls(n, universe, bits, low, np.packbits(flags, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def _low_of(self, i: int) -> int:
        at = i * self.low_bits
        piece = int.from_bytes(self._low[at >> 3 : (at + self.low_bits + 7) >> 3], "little")
        return (piece >> (at & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: jump to the sample before it, then count ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = self._high[byte] & (0xFF << (at & 7))
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = self._high[byte]
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low_of(i)

    def select_all(self, places: np.ndarray) -> np.ndarray:
        """``select`` of many places together: each goes from its sample over bytes until its one is inside."""
        places = np.asarray(places, dtype=np.int64)
        if not len(places):
            return np.zeros(0, np.int64)
        high = np.frombuffer(self._high, np.uint8)
        start = self._samples[places // SAMPLE].astype(np.int64)
        byte, left = start >> 3, places % SAMPLE
        word = high[byte] & (0xFF << (start & 7)).astype(np.uint8)
        going = np.flatnonzero(left >= _ONES[word])
        while len(going):
            left[going] -= _ONES[word[going]]
            byte[going] += 1
            word[going] = high[byte[going]]
            going = going[left[going] >= _ONES[word[going]]]
        out = (byte * 8 + _PLACE[word, left] - places) << self.low_bits
        if self.low_bits:
            bits = places[:, None] * self.low_bits + np.arange(self.low_bits)
            low = (np.frombuffer(self._low, np.uint8)[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1
            out |= (low.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return out

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self._high, np.uint8), bitorder="little"))
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self._low, np.uint8), bitorder="little")[: self.n * self.low_bits]
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            out |= (bits.reshape(self.n, self.low_bits) * weights).sum(axis=1, dtype=np.uint64)
        return out.astype(np.int64)

    def to_bytes(self) -> bytes:
        head = struct.pack(_EF, self.n, self.universe, self.low_bits, len(self._low), len(self._high))
        return head + self._low + self._high + self._samples.tobytes()

    @classmethod
    def read(cls, data, at: int) -> tuple[EliasFano, int]:
        """The sequence at ``at`` and the place after it."""
        n, universe, bits, low, high = struct.unpack_from(_EF, data, at)
        at += struct.calcsize(_EF)
        samples = 4 * ((n + SAMPLE - 1) // SAMPLE)
        cuts = [at, at + low, at + low + high, at + low + high + samples]
        parts = [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        return cls(n, universe, bits, *parts), cuts[-1]


def pack_block(part: int, block: int, keys: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One block from documents in ascending key order; null keys come first."""
    bounds = np.concatenate([[0], np.cumsum([len(x) // width for x in ids])]).astype(np.int64)
    nulls = sum(k is None for k in keys)
    known = [k for k in keys if k is not None]
    base = known[0] if known else 0
    offsets = np.array([k - base for k in known], dtype=np.uint64)
    head = struct.pack(_HEAD, MAGIC, part, block, width, len(keys), int(bounds[-1]))
    return b"".join([head, struct.pack("<qI", base, nulls), EliasFano.encode(bounds).to_bytes(), EliasFano.encode(offsets).to_bytes(), *ids])


class Block:
    """A block read back: ``key(i)``, ``bounds`` and ``ids(i)``."""

    def __init__(self, data, at: int):
        magic, self.part, self.block, self.width, self.documents, self.total = struct.unpack_from(_HEAD, data, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += struct.calcsize(_HEAD)
        self.base, self.nulls = struct.unpack_from("<qI", data, at)
        self.bounds, at = EliasFano.read(data, at + 12)
        self.keys, at = EliasFano.read(data, at)
        self._data, self._at = data, at
        self.end = at + self.total * self.width

    def key(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.keys.select(i - self.nulls)

    def ids(self, i: int) -> np.ndarray:
        """Document i's ids: two selects and a slice of the id array."""
        a, b = self.bounds.select(i), self.bounds.select(i + 1)
        return np.frombuffer(self._data, dtype=f"<u{self.width}", count=b - a, offset=self._at + a * self.width)


def blocks_of(data: bytes) -> Iterator[Block]:
    at = 0
    while at < len(data):
        block = Block(data, at)
        yield block
        if data[block.end : block.end + 1] != b"\n":
            raise ValueError("a block does not end where its header says")
        at = block.end + 1


def _text_bytes(docs: DataFrame, text: str) -> int:
    """About how many bytes of text there are: the planner's size of a table of files, else a sum."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < 1 << 50:
        return size
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", files: int | None = None
) -> None:
    """Tokenise ``docs`` and write token files under ``path`` in ascending key order.

    Null text: empty (the end id alone). Null keys come first. Rows with equal
    keys follow each other, ordered by text. Other columns are ignored.
    ``files`` sets the number of ranges, one file each; by default as many as
    make files of about FILE_BYTES of text, by the input's size, and at least
    spark.sql.shuffle.partitions. Texts, not ids, are shuffled, since ids need no second pass then. A range boundary may fall
    between rows of one key, so no key is too frequent for a file.
    """
    spark = docs.sparkSession
    files = files or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-_text_bytes(docs, text) // FILE_BYTES))
    order = ["_key", "_hash", "_row"]
    ranged = (
        docs.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
        .withColumns({"_hash": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .select("_key", "_text")
    )

    def blocks(batches):
        from pyspark import TaskContext

        encoder = word_encoder(tokenizer)
        width = encoder.dtype.itemsize
        end = int(end_id).to_bytes(width, "little")
        part, number, keys, ids, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            keys += batch.column("_key").to_pylist()
            new = [x + end for x in encoder.encode(batch.column("_text"))]
            ids += new
            held += sum(map(len, new)) // width
            if held >= BLOCK_IDS:
                yield pa.RecordBatch.from_pydict({"block": [pack_block(part, number, keys, ids, width)]}, schema=pa.schema([("block", pa.binary())]))
                number, keys, ids, held = number + 1, [], [], 0
        if keys:
            yield pa.RecordBatch.from_pydict({"block": [pack_block(part, number, keys, ids, width)]}, schema=pa.schema([("block", pa.binary())]))

    # Spark's text writer puts a string's bytes into the file as they are, and a line feed after each
    ranged.mapInArrow(blocks, "block binary").select(F.col("block").cast("string").alias("value")).write.option("compression", "none").text(path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, start): ids of all blocks before, from the headers.

    Totals run within a file first, then over one row per file.
    """

    def headers(batches):
        for batch in batches:
            for data in batch.column("content"):
                rows = [(b.part, b.block, b.total) for b in blocks_of(data.as_buffer().to_pybytes())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["part", "block", "total"]
                )

    blocks = _contents(spark, path).mapInArrow(headers, "part bigint, block bigint, total bigint")
    parts = blocks.groupBy("part").agg(F.sum("total").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("total").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = parts.select("part", before.alias("file_start"))
    return blocks.withColumn("inside", inside).join(files, "part").select("part", "block", (F.col("file_start") + F.col("inside")).alias("start"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: part, block, doc_id, block_start, n_tokens, ids.

    ``block_start`` counts the ids before the document in its block;
    ``ids`` holds little-endian unsigned 32-bit integers.
    """
    schema = pa.schema(
        [("part", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("block_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def documents(batches):
        for batch in batches:
            for data in batch.column("content"):
                for b in blocks_of(data.as_buffer().to_pybytes()):
                    bounds = b.bounds.select_all(np.arange(b.documents + 1))
                    keys = [None] * b.nulls + (b.keys.select_all(np.arange(b.documents - b.nulls)) + b.base).tolist()
                    ids = np.frombuffer(b._data, dtype=f"<u{b.width}", count=b.total, offset=b._at).astype("<u4").tobytes()
                    cut = (4 * bounds).tolist()
                    n = b.documents
                    for at in range(0, n, 2000):
                        to = min(n, at + 2000)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(to - at, b.part), pa.int64()),
                                pa.array(np.full(to - at, b.block), pa.int64()),
                                pa.array(keys[at:to], pa.int64()),
                                pa.array(bounds[at:to]),
                                pa.array(np.diff(bounds[at : to + 1])),
                                pa.array([ids[cut[i] : cut[i + 1]] for i in range(at, to)], pa.binary()),
                            ],
                            schema=schema,
                        )

    ddl = "part bigint, block bigint, doc_id bigint, block_start bigint, n_tokens bigint, ids binary"
    return _contents(spark, path).mapInArrow(documents, ddl)


def op2_elias_fano_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents → token files → (doc_id, start, n_tokens, ids_crc32) read back from them."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, "word_bpe_49k.json", end_id=2)
    digests = read_token_files(spark, path).select("part", "block", "doc_id", "block_start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return digests.join(read_block_starts(spark, path), ["part", "block"]).select(
        "doc_id", (F.col("start") + F.col("block_start")).alias("start"), "n_tokens", "ids_crc32"
    )
