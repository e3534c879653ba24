"""Product codes of vectors: k-means with adaptive bounds, in whole numbers.

Each vector is cut into four parts; a part's codebook begins as that part of the
256 smallest ids and moves for four rounds. A round assigns every part to its
nearest entry, then puts each entry at the floored mean of its parts.

Assignment keeps, for every part, the entries nearest to it besides its own: b of
them with lower bounds in ascending order, and one outer bound for all the rest
(after Drake and Hamerly). When entries move, a bound falls by its entry's step and
the outer one by the largest step. The distance to the own entry is computed
anew in whole numbers; where it is below all bounds, nothing else is looked at.
Where it isn't, the listed entries are measured in whole numbers, and where it
reaches the outer bound all entries are. Bounds are rounded down and compared
with a margin, so floating point never decides: ties go to the lower index. b
adapts in each block of vectors: it shrinks to the depth that was needed and grows
where the outer bound failed often.

State is a table with one row per block of vectors, written after each round:
a lost executor costs a task, not a round. Sums and counts of entries are added
up by Spark; codebooks (256 entries a part at most) travel to the tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import stored, table, trimmed
from vistra.operators.join import spread_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Components are held between -LIMIT and LIMIT (|x| up to 16,384), so that all sums and squares fit 64 bits.
LIMIT = 1 << 24
# Listed entries: at the start, at least, at most.
FIRST_LISTED, LEAST_LISTED, MOST_LISTED = 16, 4, 64
BLOCK_VECTORS = 2048
# Up to this magnitude of a component, distances by matrix products in doubles are exact.
EXACT = 1 << 20

_STATE = "ids binary, id_nulls binary, labels binary, vectors binary, lists binary, own binary, error binary, sums array<bigint>"


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (rows x entries) of whole numbers, exact."""
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) <= EXACT // max(1, x.shape[1]):
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in entries], axis=1)


def _down(x: np.ndarray) -> np.ndarray:
    """Doubles rounded to singles that are not above them."""
    out = x.astype(np.float32)
    return np.where(out.astype(np.float64) > x, np.nextafter(out, np.float32(-np.inf)), out)


class PartState:
    """What a block of one part keeps: own entry, b listed entries with bounds, outer bound."""

    def __init__(self, own: np.ndarray, listed: np.ndarray, bounds: np.ndarray, outer: np.ndarray):
        self.own, self.listed, self.bounds, self.outer = own, listed, bounds, outer

    @classmethod
    def fresh(cls, rows: int, listed: int) -> PartState:
        """No knowledge: every outer bound fails."""
        return cls(np.zeros(rows, np.uint8), np.zeros((rows, listed), np.uint8), np.full((rows, listed), -np.inf, np.float32), np.full(rows, -np.inf, np.float32))

    def nearest(self, x: np.ndarray, entries: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, int, int]:
        """Assign all rows anew after ``entries`` moved by ``steps``.

        Returns squared distances to the own entries, how many rows needed all
        entries, and how many distances to others were measured.
        """
        k, b, rows = len(entries), self.listed.shape[1], len(x)
        bounds = self.bounds.astype(np.float64) - steps[self.listed]
        outer = self.outer.astype(np.float64) - steps.max(initial=0.0)
        best = ((x - entries[self.own]) ** 2).sum(axis=1)
        reach = np.sqrt(best.astype(np.float64))
        reach += 1e-9 * (1 + reach)
        everywhere = reach >= outer
        some = ~everywhere & (reach[:, None] >= bounds).any(axis=1) if b else np.zeros(rows, bool)
        depth = int(((reach[:, None] >= bounds) & some[:, None]).sum(axis=1).max(initial=0)) if b else 0
        measured = 0

        at = np.flatnonzero(some)
        if len(at):  # measure the listed entries in whole numbers
            ids = self.listed[at].astype(np.int64)
            far = ((x[at][:, None, :] - entries[ids]) ** 2).sum(axis=2)
            measured += far.size
            far[ids == self.own[at][:, None]] = np.iinfo(np.int64).max  # an empty place
            every = np.concatenate([best[at][:, None], far], axis=1)
            names = np.concatenate([self.own[at].astype(np.int64)[:, None], ids], axis=1)
            order = np.lexsort((names, every), axis=1)
            every, names = np.take_along_axis(every, order, axis=1), np.take_along_axis(names, order, axis=1)
            best[at], self.own[at], self.listed[at] = every[:, 0], names[:, 0], names[:, 1:]
            bounds[at] = np.sqrt(every[:, 1:].astype(np.float64)) * (1 - 1e-12)

        at = np.flatnonzero(everywhere)
        keep = min(b, k - 1)
        for i in range(0, len(at), 1024):
            part = at[i : i + 1024]
            far = squares(x[part], entries)
            measured += far.size
            key = far * k + np.arange(k)  # ties by index
            nearest = np.argpartition(key, min(keep + 1, k - 1), axis=1)[:, : keep + 2]
            order = np.argsort(np.take_along_axis(key, nearest, axis=1), axis=1)
            nearest = np.take_along_axis(nearest, order, axis=1)
            away = np.take_along_axis(far, nearest, axis=1)
            best[part], self.own[part] = away[:, 0], nearest[:, 0]
            self.listed[part, :keep] = nearest[:, 1 : keep + 1]
            bounds[part, :keep] = np.sqrt(away[:, 1 : keep + 1].astype(np.float64)) * (1 - 1e-12)
            bounds[part, keep:] = np.inf
            outer[part] = np.sqrt(away[:, keep + 1].astype(np.float64)) * (1 - 1e-12) if k > keep + 1 else np.inf

        order = np.argsort(bounds, axis=1, kind="stable")
        self.listed, bounds = np.take_along_axis(self.listed, order, axis=1), np.take_along_axis(bounds, order, axis=1)
        self.bounds, self.outer = _down(bounds), _down(outer)
        self._adapt(depth, len(at), rows)
        return best, len(at), measured

    def _adapt(self, depth: int, failed: int, rows: int) -> None:
        """List twice as many where over an eighth of the outer bounds failed after the first round, else as deep as was needed."""
        b = self.listed.shape[1]
        if failed == rows:
            return
        if 8 * failed > rows:
            wanted = min(2 * b, MOST_LISTED)
        else:
            wanted = min(b, max(depth + 1, LEAST_LISTED))
        if wanted < b:
            self.outer = np.minimum(self.outer, self.bounds[:, wanted])
            self.listed, self.bounds = self.listed[:, :wanted], self.bounds[:, :wanted]
        elif wanted > b:  # places for more, filled when a row is measured against all; until then they say nothing beyond the outer bound
            more = (self.listed.shape[0], wanted - b)
            self.listed = np.concatenate([self.listed, np.repeat(self.own[:, None], more[1], axis=1)], axis=1)
            self.bounds = np.concatenate([self.bounds, np.full(more, np.inf, np.float32)], axis=1)

    def pack(self) -> bytes:
        shape = np.array(self.listed.shape, "<i4")
        return b"".join(np.ascontiguousarray(v).tobytes() for v in (shape, self.own, self.listed, self.bounds, self.outer))

    @classmethod
    def unpack(cls, data: memoryview) -> tuple[PartState, memoryview]:
        n, b = np.frombuffer(data, "<i4", 2).tolist()
        at, out = 8, []
        for kind, shape in (("u1", (n,)), ("u1", (n, b)), ("<f4", (n, b)), ("<f4", (n,))):
            size = int(np.prod(shape)) * np.dtype(kind).itemsize
            out.append(np.frombuffer(data[at : at + size], kind).reshape(shape).copy())
            at += size
        return cls(*out), data[at:]


def whole_numbers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(_key, _label, _vector) of the rows whose vector is whole; components times 1024, floored."""
    v = F.col(vector).cast("array<double>")
    sound = F.col(vector).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = F.transform(v, lambda x: F.floor(F.least(F.greatest(x * SCALE, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    return vectors.filter(sound).select(F.col(key).cast("bigint").alias("_key"), F.col(label).cast("string").alias("_label"), held.alias("_vector"))


def blocks_of(rows: DataFrame) -> DataFrame:
    """Stored blocks of up to BLOCK_VECTORS rows each, not yet assigned."""
    schema = pa.schema([(c, pa.binary()) for c in ("ids", "id_nulls", "labels", "vectors", "lists", "own", "error")] + [("sums", pa.list_(pa.int64()))])

    def gather(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_VECTORS):
                part = batch.slice(at, BLOCK_VECTORS)
                n = part.num_rows
                keys = part.column("_key")
                x = part.column("_vector").flatten().to_numpy().astype("<i4")
                states = b"".join(PartState.fresh(n, FIRST_LISTED).pack() for _ in range(PARTS))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([v], pa.binary())
                        for v in (
                            keys.fill_null(0).to_numpy().astype("<i8").tobytes(), np.asarray(keys.is_null()).tobytes(),
                            _pack_texts(part.column("_label").to_pylist()), x.tobytes(), states, b"", b"",
                        )
                    ] + [pa.array([None], pa.list_(pa.int64()))],
                    schema=schema,
                )

    return stored(rows.mapInArrow(trimmed(gather), _STATE), "codes-blocks")


def _pack_texts(values: list[str | None]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["label"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack_texts(data: bytes) -> pa.Array:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_next_batch().column(0)


def assign(blocks: DataFrame, entries: list[np.ndarray], before: list[np.ndarray], number: int) -> DataFrame:
    """Stored blocks after one assignment; one row per task carries the sums and counts of all entries."""
    k, width = entries[0].shape
    moved = [np.sqrt(((a - b) ** 2).sum(axis=1).astype(np.float64)) * (1 + 1e-12) for a, b in zip(entries, before)]
    model = blocks.sparkSession.sparkContext.broadcast((entries, moved))
    schema = pa.schema([(c, pa.binary()) for c in ("ids", "id_nulls", "labels", "vectors", "lists", "own", "error")] + [("sums", pa.list_(pa.int64()))])

    def run(batches):
        entries, moved = model.value
        sums = np.zeros((PARTS, k, width + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["vectors"], "<i4").astype(np.int64).reshape(len(row["ids"]) // 8, PARTS, width)
                rest, states, own = memoryview(row["lists"]), [], []
                error = np.zeros(len(x), np.int64)
                for p in range(PARTS):
                    state, rest = PartState.unpack(rest)
                    far, _, _ = state.nearest(x[:, p], entries[p], moved[p])
                    error += far
                    states.append(state.pack())
                    own.append(state.own)
                    sums[p, :, width] += np.bincount(state.own, minlength=k)
                    for d in range(width):  # whole numbers below 2**53 in all: 2**24 a component, 2,048 rows
                        sums[p, :, d] += np.bincount(state.own, weights=x[:, p, d], minlength=k).astype(np.int64)
                row |= {"lists": b"".join(states), "own": np.stack(own, axis=1).tobytes(), "error": error.astype("<i8").tobytes(), "sums": None}
                yield pa.RecordBatch.from_pylist([row], schema=schema)
        if sums.any():
            yield pa.RecordBatch.from_pylist([{"sums": sums.ravel()}], schema=schema)

    return stored(blocks.filter("ids is not null").mapInArrow(trimmed(run), _STATE), f"codes-round-{number}")


def moved_entries(state: DataFrame, entries: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry at the floored mean of its parts; unused ones stay. At most 4 x 256 x (part + 1) sums reach the driver."""
    k, width = entries[0].shape
    found = state.filter("sums is not null").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("total")).toArrow()
    sums = np.zeros(PARTS * k * (width + 1), np.int64)
    sums[found["pos"].to_numpy()] = found["total"].to_numpy()
    sums = sums.reshape(PARTS, k, width + 1)
    count = sums[:, :, width:]
    return list(np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), np.stack(entries)))


def compress(
    vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, own array<int>, error) of every whole vector, and the codebooks.

    A vector that is null or holds a null, a NaN or an infinity is left out.
    Repeated rows count as often as they occur; of equal ids at the codebook's
    edge the one with the smaller vector begins it, and null ids come last.
    Fewer than ``entries`` vectors make as many entries. No vectors: no rows.
    Components beyond +-16,384 count as that. Vectors of different lengths, or of
    a length that four doesn't divide, raise ValueError. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, key, vector, label)
    first = rows.orderBy(F.asc_nulls_last("_key"), "_vector").limit(entries).select("_vector").collect()
    if not first:
        return spark.createDataFrame([], "vec_id bigint, label string, own array<int>, error bigint"), [np.zeros((0, 0), np.int64)] * PARTS
    sizes = rows.agg(F.min(F.size("_vector")).alias("low"), F.max(F.size("_vector")).alias("high")).first()
    if sizes["low"] != sizes["high"] or sizes["low"] % PARTS:
        raise ValueError(f"vectors of {sizes['low']} to {sizes['high']} components; all must have one length that {PARTS} divides")
    start = np.array([r["_vector"] for r in first], np.int64).reshape(len(first), PARTS, sizes["low"] // PARTS)
    books = [start[:, p].copy() for p in range(PARTS)]
    state, before = blocks_of(rows), books
    for n in range(rounds):
        state = assign(state, books, before, n)
        before, books = books, moved_entries(state, books)
    state = assign(state, books, before, rounds)

    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("own", pa.list_(pa.int32())), ("error", pa.int64())])

    def unfold(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                own = np.frombuffer(row["own"], np.uint8).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(own) + 1, PARTS), pa.int32()), pa.array(own))
                gone = np.frombuffer(row["id_nulls"], bool)
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=gone), _unpack_texts(row["labels"]), lists, pa.array(np.frombuffer(row["error"], "<i8"))], schema=schema)

    state = state.filter("ids is not null").select("ids", "id_nulls", "labels", "own", "error")
    return state.mapInArrow(trimmed(unfold), "vec_id bigint, label string, own array<int>, error bigint"), books


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, their errors and their labels' summed errors."""
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    code = F.concat(*[F.lower(F.lpad(F.hex(F.col("own")[p]), 2, "0")) for p in range(PARTS)])
    rows = coded.select("vec_id", code.alias("code"), "error", F.col("label").isNull().alias("_none"), F.coalesce("label", F.lit("")).alias("_label"))
    totals = rows.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"))
    full = spread_join(rows, totals, ["_none", "_label"])
    return full.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
