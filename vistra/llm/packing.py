"""Packing by the length histogram: shortest pack first, longest lengths first.

Documents become token ids with an end id and are cut into pieces of at most
``size`` ids: whole ones of ``size``, which fill a sequence each, and one rest.
Only the histogram of rest lengths (at most ``size`` - 1 numbers, whatever the
corpus) is planned over: lengths are placed longest first, each into the pack
with most room, and a pattern is a kind of pack with its count. Patterns are
then joined back to documents by rank: the k-th document of a length takes the
k-th slot of that length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistra.llm.common import stored, table, trimmed, word_encoder

SIZE = 2048
# Bytes of ids in one Arrow batch of pieces; they stand there some three times.
PIECE_BYTES = 2_000_000

# A pattern: (length, copies) pairs in placing order.
Pattern = tuple[tuple[int, int], ...]


def plan_patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, Pattern]]:
    """(count, pattern) for a histogram of lengths in 1..size.

    Longest first; a length goes to the packs with most room left, and when
    none has room, to new packs holding as many copies as fit. Each length
    splits one kind of pack in two at most and opens two at most, so
    there are at most about 3 * size patterns for any corpus.
    """
    by_room: dict[int, list[tuple[int, Pattern]]] = defaultdict(list)

    def put(count: int, pattern: Pattern, room: int) -> None:
        if count:
            by_room[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = size
        while left:
            while room >= length and not by_room.get(room):
                room -= 1
            if room < length:
                each = size // length
                put(left // each, ((length, each),), size - each * length)
                rest = left % each
                put(1 if rest else 0, ((length, rest),) if rest else (), size - rest * length)
                break
            count, pattern = by_room[room].pop()
            each = min(room // length, max(1, left // count))
            taken = min(count, left // each)
            left -= taken * each
            put(count - taken, pattern, room)
            put(taken, (*pattern, (length, each)), room - each * length)
    return [x for room in sorted(by_room) for x in by_room[room]]


def slot_table(patterns: Iterable[tuple[int, Pattern]]) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, first sequence, offset, copies), by length and rank; number of sequences.

    A row serves ``count * copies`` ranks: rank r (from the row's first) lies in
    sequence first + r // copies, r % copies lengths after the offset.
    """
    rows, ranks, sequence = [], defaultdict(int), 0
    for count, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            rows.append((length, ranks[length], sequence, offset, copies))
            ranks[length] += count * copies
            offset += length * copies
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5), sequence


def token_table(docs: DataFrame, tokenizer: str, end_id: int, size: int, key: str, text: str) -> DataFrame:
    """Stored rows: shard, doc_id, n_tokens, whole_before, rest, rest_rank, ids.

    Counts before and ranks run within a shard (the task that wrote the row).
    """
    schema = pa.schema(
        [("shard", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("whole_before", pa.int64()), ("rest", pa.int32()), ("rest_rank", pa.int64()), ("ids", pa.binary())]
    )

    def encode(batches):
        from pyspark import TaskContext

        encoder = word_encoder(tokenizer)
        width = encoder.dtype.itemsize
        end = int(end_id).to_bytes(width, "little")
        shard, whole, seen = TaskContext.get().partitionId(), 0, np.zeros(size, dtype=np.int64)
        for batch in batches:
            ids = [x + end for x in encoder.encode(batch.column("_text"))]
            n = np.array([len(x) // width for x in ids], dtype=np.int64)
            before = whole + np.cumsum(n // size) - n // size
            whole += int((n // size).sum())
            rest, ranks = n % size, np.empty(len(n), dtype=np.int64)
            for i, r in enumerate(rest.tolist()):
                ranks[i] = seen[r]
                seen[r] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), shard, np.int32)), batch.column("_key"), pa.array(n), pa.array(before), pa.array(rest.astype(np.int32)), pa.array(ranks), pa.array(ids, pa.binary())],
                schema=schema,
            )
        encoder.forget()

    source = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))
    ddl = "shard int, doc_id bigint, n_tokens bigint, whole_before bigint, rest int, rest_rank bigint, ids binary"
    return stored(source.mapInArrow(trimmed(encode), ddl), "packing-tokens")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds little-endian unsigned 32-bit integers. Sequences are
    numbered from 0 without gaps. Null text: empty (the end id alone); null or
    repeated keys are documents of their own; other columns are ignored.
    """
    spark = docs.sparkSession
    tokens = token_table(docs, tokenizer, end_id, size, key, text)
    counts = stored(tokens.groupBy("shard", "rest").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr(f"n_tokens div {size}")).alias("whole")), "packing-counts")
    # at most `size` rows reach the driver: the histogram of rest lengths
    histogram = {r["rest"]: r["rows"] for r in counts.filter("rest > 0").groupBy("rest").agg(F.sum("rows").alias("rows")).collect()}
    slots, packed = slot_table(plan_patterns(histogram, size))

    earlier = Window.partitionBy("rest").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        counts.withColumn("first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .groupBy("shard")
        .agg(F.map_from_entries(F.collect_list(F.struct("rest", "first"))).alias("first_ranks"), F.sum("whole").alias("whole"))
    )
    shards = ranks.select(
        "shard", "first_ranks", F.coalesce(F.sum("whole").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("whole_first")
    )
    placed = tokens.join(shards, "shard").select(
        "doc_id",
        "n_tokens",
        "rest",
        (F.col("whole_first") + F.col("whole_before")).alias("whole"),
        (F.element_at("first_ranks", F.col("rest")) + F.col("rest_rank")).alias("rank"),
        "ids",
    )
    # a few thousand rows at most (see plan_patterns), whatever the corpus
    plan = spark.sparkContext.broadcast(slots)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def pieces(batches):
        rows = plan.value
        # length and rank in one increasing number: rows are sorted by both
        lengths, firsts = rows[:, 0], rows[:, 1]
        lows = np.searchsorted(lengths, np.arange(size + 1))
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("doc_id", "n_tokens", "rest", "whole", "rank", "ids")}
            out: list[tuple] = []
            held = 0
            for doc, n, rest, whole, rank, ids in zip(*cols.values(), strict=True):
                wide = np.frombuffer(ids, dtype=f"<u{len(ids) // n}").astype("<u4").tobytes()
                for j in range(n // size):
                    out.append((doc, j * size, size, wide[4 * j * size : 4 * (j + 1) * size], n, packed + whole + j, 0))
                if rest:
                    lo, hi = lows[rest], lows[rest + 1] if rest + 1 <= size else len(rows)
                    at = lo + int(np.searchsorted(firsts[lo:hi], rank, side="right")) - 1
                    _, first, sequence, offset, copies = rows[at].tolist()
                    over = rank - first
                    out.append((doc, n - rest, rest, wide[4 * (n - rest) :], n, sequence + over // copies, offset + over % copies * rest))
                held += len(wide)
                if held >= PIECE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return placed.mapInArrow(trimmed(pieces), "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")


def op3_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents → pieces in sequences of at most 2048 ids; ids as their crc32."""
    return digest(pack_documents(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end_id=1))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
