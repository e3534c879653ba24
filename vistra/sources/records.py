"""CSV records that hold line breaks, read in parallel.

Files are split into blocks of bytes, and a line belongs to the block in which it
begins. Whether a line begins inside a quoted value depends on all lines
before it, so it is found by a parallel scan:

1. Each block says in which state it ends if it begins outside a quoted value and in
   which if it begins inside one. Only lines with a quote matter. One short row
   for a block with quotes.
2. The states at the beginnings of a file's blocks follow one after another from those rows.
3. Each block then cuts its records by itself. A record that crosses blocks comes out in
   pieces, at most two a block, that are put together by file and order.

A quoted value begins with a quote at a field's beginning; a quote in it is
doubled; a quote elsewhere is text. UTF-8 lines come from Spark's text source.
UTF-16 files are read by ranges of bytes that begin at a code unit, so that
the bytes of a line feed in two neighbouring characters don't end a line.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.sources.encoding import list_files, open_file

BLOCK_BYTES = 64 * 1024 * 1024
# Bytes that a task reads of a UTF-16 range, and characters that it sends on, at a time.
CHUNK_BYTES = 4 * 1024 * 1024

# Lines that end outside quoted values (Arrow's patterns, in linear time): of those that begin outside one, and inside.
_FIELD = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?'
CLOSED = rf"\A{_FIELD}(?:,{_FIELD})*\z"
CLOSED_INSIDE = rf'\A(?:[^"]|"")*"(?:[^",][^,]*)?(?:,{_FIELD})*\z'

WHOLE, CLOSING, WITHIN, OPENING, HEADER = range(5)

# Lines that no DataFrame holds: takes a function of batches of (file, block, line) and what it returns.
Reading = Callable[[Callable, str], DataFrame]

_LINES = "file bigint, block bigint, line string"


def file_name(path: Column) -> Column:
    """A short name of a file: its path without the scheme and, in a listing's metadata, without escapes."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.xxhash64(F.regexp_replace(plain, r"^[A-Za-z0-9+.-]+:/*", "/"))


def utf8_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, block, line) in the files' order within each block; a line keeps its carriage return."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(list(paths))
    return text.select(file_name(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def utf16_ranges(spark: SparkSession, paths: Sequence[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, start, stop): each file's ranges, one task each."""
    files = list_files(spark, paths).filter(F.col("length") > 2)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(block_bytes - block_bytes % 2).cast("bigint"))
    ranges = files.select("path", "length", F.explode(starts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + block_bytes - block_bytes % 2, F.col("length")).alias("stop"))
    return ranges.coalesce(1).repartition(max(1, ranges.count()))


def lines_of_range(path: str, start: int, stop: int, chunk_bytes: int = CHUNK_BYTES) -> Iterator[list[str]]:
    """The lines of a UTF-16 file with a byte-order mark that begin at bytes ``start`` to ``stop``, in lists."""
    return (text.split("\n") for text in texts_of_range(path, start, stop, chunk_bytes))


def texts_of_range(path: str, start: int, stop: int, chunk_bytes: int = CHUNK_BYTES) -> Iterator[str]:
    """Runs of whole lines, the line feed at a run's end left out, of those that begin at bytes ``start`` to ``stop``."""
    with open_file(path) as f:
        big = f.read(2) == b"\xfe\xff"
        codec, feed = ("utf-16-be", b"\x00\n") if big else ("utf-16-le", b"\n\x00")

        def aligned(data: bytes, at: int, last: bool = False) -> int:
            """Where the first (last) line feed stands from ``at`` on, at a code unit; -1 for none."""
            at = data.rfind(feed) if last else data.find(feed, at)
            while at >= 0 and at % 2:
                at = data.rfind(feed, 0, at + 1) if last else data.find(feed, at + 1)
            return at

        # a line begins at ``start`` where the unit before it is a line feed
        base = max(start - 2, 2)
        f.seek(base)
        data, skipping = b"", start > 2
        while True:
            chunk = f.read(chunk_bytes)
            data += chunk
            if skipping:
                at = aligned(data, 0)
                if at < 0:
                    if not chunk:
                        return
                    keep = len(data) % 2  # whole units are passed over
                    base, data = base + len(data) - keep, data[len(data) - keep :]
                    if base >= stop:
                        return
                    continue
                base, data, skipping = base + at + 2, data[at + 2 :], False
            if base >= stop:
                return
            end = aligned(data, max(stop - 2 - base, 0))  # the line feed of the last line that begins before stop
            if end < 0 and chunk:
                cut = aligned(data, 0, last=True)
                if cut < 0:
                    continue
                lines, base, data = data[:cut], base + cut + 2, data[cut + 2 :]
                yield lines.decode(codec, "replace")
                continue
            text = (data if end < 0 else data[:end]).decode(codec, "replace")
            if text or end >= 0:  # nothing after a file's last line feed is no line
                yield text
            return


def utf16_reading(spark: SparkSession, paths: Sequence[str], block_bytes: int = BLOCK_BYTES) -> Reading:
    """The lines of UTF-16 files for a function of their batches, which runs in the tasks that read them, one for each range of bytes."""

    def read(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for path, name, start, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "file", "start", "stop"))):
                for text in texts_of_range(path, start, stop):
                    lines = pc.split_pattern(pa.array([text], pa.string()), "\n").flatten()
                    for at in range(0, len(lines), 20_000):
                        part = lines.slice(at, 20_000)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(part), pa.int64()), pa.array([start] * len(part), pa.int64()), part], names=["file", "block", "line"]
                        )

    ranges = utf16_ranges(spark, paths, block_bytes).withColumn("file", F.xxhash64("path"))
    return lambda function, ddl: ranges.mapInArrow(lambda batches: function(read(batches)), ddl)


def utf16_lines(spark: SparkSession, paths: Sequence[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, line) of UTF-16 files, a task for each range of bytes."""
    return utf16_reading(spark, paths, block_bytes)(lambda batches: batches, _LINES)


def _mapped(lines: DataFrame | Reading, function, ddl: str) -> DataFrame:
    return lines.mapInArrow(function, ddl) if isinstance(lines, DataFrame) else lines(function, ddl)


def line_ends(lines) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line of an Arrow array ends inside a quoted value: if it begins outside one, and if inside."""
    import pyarrow as pa
    import pyarrow.compute as pc

    outside, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quoted):
        part = lines.take(pa.array(quoted))
        for known, closed in ((outside, CLOSED), (inside, CLOSED_INSIDE)):
            known[quoted] = ~pc.match_substring_regex(part, closed).to_numpy(zero_copy_only=False)
    return outside, inside


def states_after(ends: tuple[np.ndarray, np.ndarray], inside: bool) -> np.ndarray:
    """Whether quoted text goes on after each of some lines, from the state before the first of them.

    A line leaves a state as it is, turns it or sets it: it follows from the last line that
    sets it and the number of turns after that.
    """
    from_outside, from_inside = ends
    if not len(from_outside):
        return from_outside
    last = np.maximum.accumulate(np.where(from_outside == from_inside, np.arange(len(from_outside)), -1))
    turns = np.cumsum(from_outside & ~from_inside)
    begun, before = np.where(last >= 0, from_outside[last], inside), np.where(last >= 0, turns[last], 0)
    return begun ^ ((turns - before) % 2 == 1)


def ends_open(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted value, from the state at its beginning."""
    import pyarrow as pa

    return bool(line_ends(pa.array([line], pa.string()))[inside][0])


def _block_parts(batch) -> Iterator[tuple[tuple[int, int], object]]:
    """((file, block), lines) of a batch, in its order."""
    files, blocks = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    changes = (np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist()
    for a, b in zip([0, *changes], [*changes, batch.num_rows]):
        if b > a:
            yield (int(files[a]), int(blocks[a])), batch.column("line").slice(a, b - a)


_STATES = "file bigint, block bigint, opens boolean, from_outside boolean, from_inside boolean"


def block_states(lines: DataFrame | Reading) -> DataFrame:
    """(file, block, opens, from_outside, from_inside) of the blocks with quotes.

    ``from_...``: whether the block ends inside a quoted value, by the state at its
    beginning; ``opens``: whether any line does, from outside.
    """

    def scan(batches):
        import pyarrow as pa

        where, opens, ends = None, False, (False, True)

        def row():
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*where, opens, *ends)], names=["file", "block", "opens", "from_outside", "from_inside"])

        for batch in batches:
            for place, part in _block_parts(batch):
                if place != where:
                    if where is not None:
                        yield row()
                    where, opens, ends = place, False, (False, True)
                found = line_ends(part)
                after = [states_after(found, begun) for begun in ends]
                opens = opens or bool(after[0].any())
                ends = (bool(after[0][-1]), bool(after[1][-1]))
        if where is not None:
            yield row()

    return _mapped(lines.filter(F.contains("line", F.lit('"'))) if isinstance(lines, DataFrame) else lines, scan, _STATES)


def inside_blocks(states: DataFrame) -> DataFrame:
    """(file, next): a block of that file with quotes after which quoted text goes on, and the next block with quotes or none.

    One row for each block with quotes is read, file by file.
    """

    def follow(frame):
        import pandas as pd

        inside, rows = False, []
        frame = frame.sort_values("block")
        for block, outside, within in zip(frame["block"], frame["from_outside"], frame["from_inside"]):
            before, inside = inside, bool(within if inside else outside)
            if before:
                rows[-1][2] = block
            if inside:
                rows.append([frame["file"].iloc[0], block, 2**62])
        return pd.DataFrame(rows, columns=["file", "after", "until"]).astype("int64")

    return states.groupBy("file").applyInPandas(follow, "file bigint, after bigint, until bigint")


def cut_records(lines: DataFrame | Reading, spans: list[tuple[int, int, int]], header: bool) -> DataFrame:
    """(kind, file, block, text): whole records, pieces of those that cross blocks, and each file's header."""
    going_on: dict[int, list[tuple[int, int]]] = {}
    for name, after, until in sorted(spans):
        going_on.setdefault(name, []).append((after, until))

    def begins_inside(name: int, block: int) -> bool:
        found = going_on.get(name, [])
        at = bisect_left(found, (block,))
        return at > 0 and block <= found[at - 1][1]

    def cut(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        where, inside, held, kind = None, False, [], WHOLE
        names = ["kind", "file", "block", "text"]

        def rows(kind, texts):
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.int32()), pa.array([where[0]] * n, pa.int64()), pa.array([where[1]] * n, pa.int64()), texts], names=names)

        def piece(kind, lines):
            return rows(kind, pa.array(["\n".join(lines)], pa.string()))

        for batch in batches:
            for place, part in _block_parts(batch):
                if place != where:
                    if held:  # the block before ends inside a value
                        yield piece(WITHIN if kind == CLOSING else OPENING, held)
                    where, held = place, []
                    inside = begins_inside(*where)
                    kind = CLOSING if inside else HEADER if header and not where[1] else WHOLE
                after = states_after(line_ends(part), inside)
                inside = bool(after[-1])
                stops = np.flatnonzero(~after) + 1  # a record's last line, counted from one
                if not len(stops):
                    held.extend(part.to_pylist())
                    continue
                if held or kind != WHOLE:  # the record that lines before belong to, or a block's first
                    first = int(stops[0])
                    yield piece(kind, [*held, *part.slice(0, first).to_pylist()])
                    held, kind, part, stops = [], WHOLE, part.slice(first), stops[1:] - first
                if len(stops):
                    last = int(stops[-1])
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), part.slice(0, last))
                    yield rows(WHOLE, part.slice(0, last) if len(stops) == last else pc.binary_join(lists, "\n"))
                    part = part.slice(last)
                held = part.to_pylist()
        if held:
            yield piece(WITHIN if kind == CLOSING else OPENING, held)

    return _mapped(lines, cut, "kind int, file bigint, block bigint, text string")


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """(kind, text) of the records that cross blocks: at most two pieces a block are moved."""
    from pyspark.sql import Window

    # in a block, the piece that ends a record stands before the one that begins another
    order = Window.partitionBy("file").orderBy("block", "kind")
    begun = pieces.withColumn("record", F.sum((F.col("kind") == OPENING).cast("int")).over(order))
    whole = begun.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "text"))).alias("parts"))
    return whole.select(F.lit(WHOLE).alias("kind"), F.array_join(F.col("parts.text"), "\n").alias("text"))


def read_records(lines: DataFrame | Reading, header: bool, states: DataFrame | None = None) -> DataFrame:
    """(kind, text) of all records of the files, blank ones left out.

    Driver-side are the places where quoted text crosses a block's end: some 24
    bytes each, at most one a block. ``states``: what ``block_states`` found of
    the same lines, where that is known.
    """
    spans = [tuple(r) for r in inside_blocks(block_states(lines) if states is None else states).collect()]
    cut = cut_records(lines, spans, header)
    if spans:
        across = cut.filter(F.col("kind").isin(CLOSING, WITHIN, OPENING))
        cut = cut.filter(F.col("kind").isin(WHOLE, HEADER)).select("kind", "text").unionByName(joined_pieces(across))
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return cut.select("kind", text.alias("text")).filter(F.length(F.trim("text")) > 0)


def kept_states(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """``block_states`` of the lines, found once: a row of some 30 bytes for a block with quotes."""
    return spark.createDataFrame(block_states(lines).collect(), _STATES)


def broken_files(spark: SparkSession, paths: Sequence[str], states: DataFrame | None = None) -> list[str]:
    """The UTF-8 files in which a record goes over a line's end (paths as Spark lists them)."""
    states = block_states(utf8_lines(spark, paths)) if states is None else states
    opened = states.filter("opens").select("file").distinct()
    hashes = [r["file"] for r in opened.collect()]
    if not hashes:
        return []
    escaped = F.replace("path", F.lit("%"), F.lit("%25"))
    found = list_files(spark, paths).filter(file_name(escaped).isin(hashes))
    return sorted(r["path"] for r in found.collect())
