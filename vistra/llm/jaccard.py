"""N-gram Jaccard join as a metric-space join: pivots, regions, windows.

Jaccard distance d = 1 - |x & y| / |x | y| is a metric. Two levels of pivots
split the space, and the triangle inequality says which documents must stand
in more than one region, so that no pair within ``1 - similarity`` is lost.

Level 1. Pivots are the one-shingle sets in a fixed order, rarest first (by a
count sketch of all shingles, ties by hash). A document lies in the region of
its nearest one, its first shingle. Two sets within distance 0.25 miss at most
a quarter of each other, so a partner's first shingle is among the document's
first floor(n / 4) + 1 ones: that window of regions holds a copy of it. A few
more regions (n / 8) are taken, of which as many must then be shared: a
document that shares fewer has no partner and is dropped, which spares nearly
all that merely have a passage in common.

Level 2. In each region the document with most shared regions is the pivot,
and exact distances to it are taken. Those within 0.25 are linked to it, hence to
each other, and form its cell. What is left are pairs of different cells.
Regions that hang together are joined as one, in blocks of bounded size, large ones
apart by sizes that allow a link: each document outside the largest cell is a pivot in its turn against all blocks,
and is passed over where the windows around earlier pivots (distances that
differ by at most 0.25), the sizes or a cell in common leave it no partner. Every
link between two components is found; a link within one changes nothing.

Equal sets are one node from the start. Sets and shingles are named by 64-bit
hashes: among n different ones the chance of any clash is about n * n / 2 ** 65.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vistra.llm.common import Words, discard, in_groups, mix64, shuffles_removed, stored, table, text_groups, trimmed
from vistra.operators.join import observe_keys, observed_keys, spread_join

SHINGLE = 5
PERCENT = 75
# Cells of the count sketch that orders shingles, and bits of the set of hashes
# that spares building sets of texts without a partner. They bound what is
# broadcast (4 MB and 16 MB); results do not depend on them.
SKETCH_CELLS = 1 << 22
SKETCH_SLICES = 64
FILTER_BITS = 1 << 27
# Shingles in one block of a region; a document with more is a block of its own.
BLOCK_SHINGLES = 200_000
# Pivots of a block whose distances are kept for windows.
WINDOW_PIVOTS = 8


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes (uint64).

    Fewer than ``size`` words: the whole sequence as one. No words: empty.
    """
    return [s for part in in_groups(texts) for s in _sets_of_group(part, size)]


def _sets_of_group(texts: list[str], size: int) -> list[np.ndarray]:
    words = Words(texts, lower=True)
    value, _, _ = words.windows(size)
    count = np.diff(words.first)
    stops = np.cumsum(np.maximum(count - size + 1, 0))
    at = 0
    for to in stops.tolist():
        value[at:to].sort()
        at = to
    new = np.ones(len(value), dtype=bool)
    if len(value):
        new[1:] = value[1:] != value[:-1]
        starts = np.concatenate([[0], stops[:-1]])
        new[starts[starts < len(value)]] = True
    cuts = np.concatenate([[0], np.cumsum(new)])[stops].tolist()
    value, out, at = value[new], [], 0
    for i, (n, to) in enumerate(zip(count.tolist(), cuts, strict=True)):
        if 0 < n < size:
            out.append(_short(words.hash[words.first[i] : words.first[i] + n]))
        else:
            out.append(value[at:to])
        at = to
    return out


def _short(words: np.ndarray) -> np.ndarray:
    """One hash for a sequence of few words, unlike any of a longer one's shingles."""
    acc = np.array([len(words)], dtype=np.uint64)
    for k in range(len(words)):
        acc = mix64(acc + words[k : k + 1])
    return acc


def set_name(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set, from the sum and the number of its hashes."""
    total = (int(np.add.reduce(mix64(shingles), dtype=np.uint64)) + len(shingles) * 0x9E3779B97F4A7C15) % 2**64
    return int(mix64(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many first pivots a set of n shingles must stand at.

    A partner misses at most n - ceil(0.75 n) of them, so of one more, one is
    shared, and each yet further one (n // 8 of them) is another.
    """
    return n - -(-percent * n // 100) + n // 8 + 1


def least_shared(n: F.Column, percent: int = PERCENT) -> F.Column:
    """How many regions a set of n shingles shares with any partner: as many as the smallest possible partner takes beyond what it may miss."""
    return F.floor(F.ceil(n * percent / 100) / 8) + 1


# --- level 1: regions of one-shingle pivots ---------------------------------------------


def name_sets(docs: DataFrame, size: int, key: str, text: str, seen: Observation) -> tuple[DataFrame, np.ndarray]:
    """Stored rows _key, text_hash, node, n_shingles; and the sum of the sketches that tasks make on the way.

    ``seen`` finds the sets that very many rows have, for the joins by node.
    """
    schema = pa.schema(
        [("_key", pa.int64()), ("text_hash", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64()), ("slice", pa.int32()), ("sketch", pa.binary())]
    )
    source = docs.select(F.col(key).cast("bigint").alias("_key"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("_text"))

    def name(batches):
        import zlib

        cells = np.zeros(SKETCH_CELLS, dtype=np.uint32)
        for batch in batches:
            names, counts = [], []
            for _, texts in text_groups(batch, "_text"):
                sets = shingle_sets(texts, size)
                np.add.at(cells, np.concatenate(sets) % np.uint64(SKETCH_CELLS), np.uint32(1))
                names += [set_name(s) for s in sets]
                counts += [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"), batch.column("text_hash"), pa.array(names, pa.int64()),
                    pa.array(counts, pa.int64()), pa.nulls(len(names), pa.int32()), pa.nulls(len(names), pa.binary()),
                ],
                schema=schema,
            )
        for i, part in enumerate(cells.reshape(SKETCH_SLICES, -1)):
            if part.any():
                data = pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 4 + [pa.array([i], pa.int32()), data], schema=schema)

    rows = source.mapInArrow(trimmed(name), "_key bigint, text_hash bigint, node bigint, n_shingles bigint, slice int, sketch binary")
    both = stored(observe_keys(rows, ["node"], seen), "jaccard-named")
    rank = total_sketch(both)
    # sketches are most of it
    named = stored(both.filter("sketch is null").select("_key", "text_hash", "node", "n_shingles"), "jaccard-sets")
    discard(both)
    return named, rank


def total_sketch(rows: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches, in logarithmic steps of a quarter octave (uint8).

    Slices are summed apart, over groups of tasks and then over the groups;
    both are about the square root of the number of tasks.
    """
    import zlib

    def add(table):
        total = np.zeros(SKETCH_CELLS // SKETCH_SLICES, dtype=np.uint64)
        for data in table.column("sketch"):
            total += np.frombuffer(zlib.decompress(data.as_py()), dtype=np.uint32)
        data = zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)
        return pa.table([table.column("slice")[:1].cast(pa.int32()), pa.array([data], pa.binary())], names=["slice", "sketch"])

    sketches = rows.filter("sketch is not null").select("slice", "sketch")
    groups = int((sketches.count() / SKETCH_SLICES) ** 0.5) + 1
    part = F.pmod(F.xxhash64("sketch"), F.lit(groups)).alias("part")
    sums = sketches.groupBy("slice", part).applyInArrow(add, "slice int, sketch binary").groupBy("slice").applyInArrow(add, "slice int, sketch binary")
    cells = np.zeros((SKETCH_SLICES, SKETCH_CELLS // SKETCH_SLICES), np.uint32)
    with shuffles_removed(rows.sparkSession):
        for r in sums.collect():
            cells[r["slice"]] = np.frombuffer(zlib.decompress(r["sketch"]), dtype=np.uint32)
    return np.round(4 * np.log2(cells.ravel().astype(np.float64) + 1)).astype(np.uint8)


def regions(docs: DataFrame, rank: np.ndarray, size: int, percent: int, text: str) -> DataFrame:
    """Rows (shingle, node): the regions that each set stands in."""
    steps = docs.sparkSession.sparkContext.broadcast(rank)

    def place(batches):
        seen: set[int] = set()
        for batch in batches:
            shingles, nodes, counts = [], [], []
            for s in (s for _, texts in text_groups(batch, "_text") for s in shingle_sets(texts, size)):
                if not len(s):
                    continue
                node = set_name(s)
                if node in seen:
                    continue
                if len(seen) < 100_000:  # spares copies that meet in one task; others are harmless
                    seen.add(node)
                k = prefix_length(len(s), percent)
                order = np.lexsort((s, steps.value[(s % np.uint64(SKETCH_CELLS)).astype(np.int64)]))[:k]
                shingles.append(s[order])
                nodes.append(node)
                counts.append(len(order))
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), counts))], names=["shingle", "node"]
                )

    source = docs.select(F.col(text).cast("string").alias("_text"))
    return source.mapInArrow(trimmed(place), "shingle bigint, node bigint")


def bit_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit set of ``keys``' one long column: at most bits / 64 words reach the driver."""
    at = F.pmod(F.col(keys.columns[0]), F.lit(bits))
    words = keys.select(at.alias("at")).groupBy((F.col("at") / 64).cast("bigint").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


def _in_filter(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.mod(keys, FILTER_BITS)
    return (words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def in_company(rows: DataFrame) -> DataFrame:
    """The distinct (shingle, node) rows of regions with two documents or more.

    One exchange by shingle; in each partition the sorted rows run past, and one
    row is held at a time.
    """
    schema = pa.schema([("shingle", pa.int64()), ("node", pa.int64())])

    def run(batches):
        held, done = None, False  # the row before, and whether it is out already
        for batch in batches:
            s, n = (batch.column(c).to_numpy() for c in ("shingle", "node"))
            if not len(s):
                continue
            if held is not None:
                s, n = np.concatenate([[held[0]], s]), np.concatenate([[held[1]], n])
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1])
            s, n = s[new], n[new]
            several = np.zeros(len(s), bool)
            several[1:] = s[1:] == s[:-1]
            several[:-1] |= several[1:]
            last = bool(several[-1]) or (len(s) == 1 and done)
            if done:
                several[0] = False
            held, done = (s[-1], n[-1]), last
            if several.any():
                yield pa.RecordBatch.from_arrays([pa.array(s[several]), pa.array(n[several])], schema=schema)

    ordered = rows.repartition("shingle").sortWithinPartitions("shingle", "node")
    return ordered.mapInArrow(trimmed(run), "shingle bigint, node bigint")


def shared_regions(rows: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Stored (shingle, node, pivot, documents, alike): regions with two documents or more, of documents with enough of them."""
    company = stored(in_company(rows), "jaccard-company")
    # all of a document's partners together share no less with it than one
    enough = company.groupBy("node").agg(F.count(F.lit(1)).alias("regions")).join(sizes, "node")
    enough = stored(enough.filter(F.col("regions") >= least_shared(F.col("n"), percent)).select("node", "regions"), "jaccard-enough")
    members = company.join(enough, "node")
    found = stored(members.join(_distinct_regions(members).hint("shuffle_hash"), "shingle").select("shingle", "node", "pivot", "documents", "alike"), "jaccard-members")
    discard(company, enough)
    return found


def _distinct_regions(rows: DataFrame) -> DataFrame:
    """(shingle, pivot, documents, alike) of regions with two documents or more, one of those with the same documents (``alike`` of them).

    The pivot is the document with most shared regions: in a group of near copies
    one near its middle. Near duplicates share many shingles, so most regions
    are alike. Number, lowest, highest, pivot and two sums (xor) of hashes stand
    for the documents of a region.
    """
    central = F.col("regions") * 2**32 + F.pmod("node", F.lit(2**32))
    marks = {"documents": F.count(F.lit(1)), "low": F.min("node"), "high": F.max("node"), "pivot": F.max_by("node", central)}
    marks |= {f"mark{i}": F.bit_xor(F.xxhash64("node", F.lit(i))) for i in range(2)}
    groups = rows.groupBy("shingle").agg(*[f.alias(c) for c, f in marks.items()]).filter("low < high")
    one = groups.groupBy(*marks).agg(F.min("shingle").alias("shingle"), F.count(F.lit(1)).alias("alike"))
    return one.select("shingle", "pivot", "documents", "alike")


# --- level 2: document pivots, windows, recursion ------------------------------------


def candidate_sets(docs: DataFrame, named: DataFrame, nodes: DataFrame, size: int, text: str) -> DataFrame:
    """Stored (node, n, shingles): the sets of ``nodes``, one row each, from their texts."""
    texts = named.join(nodes, "node").groupBy("node").agg(F.min("text_hash").alias("text_hash")).select("text_hash").distinct()
    texts = stored(texts, "jaccard-texts")
    source = docs.select(F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("_text"))
    if 8 * texts.count() > FILTER_BITS:  # too many for the bit set to tell them from others: their texts are moved
        source, bits = source.join(texts, "text_hash", "left_semi"), np.full(FILTER_BITS // 8, 255, np.uint8)
    else:
        bits = bit_filter(texts)
    wanted = docs.sparkSession.sparkContext.broadcast(bits)
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def build(batches):
        seen: set[int] = set()
        for batch in batches:
            keep = _in_filter(wanted.value, batch.column("text_hash").to_numpy())
            hashes = batch.column("text_hash").to_numpy()
            for i in np.flatnonzero(keep).tolist():
                keep[i] = hashes[i] not in seen
                if len(seen) < 100_000:
                    seen.add(int(hashes[i]))
            part = batch.filter(pa.array(keep))
            for _, texts in text_groups(part, "_text"):
                sets = shingle_sets(texts, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_name(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], schema=schema
                )

    # the few sets that the bit set lets through besides are of no node that is asked for
    found = stored(source.mapInArrow(trimmed(build), "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "jaccard-candidates")
    wanted.destroy()
    discard(texts)
    return found


def distances(pairs: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b, shared, total): exact intersection and union sizes of pairs.

    A pivot's partners are dealt into blocks of some BLOCK_SHINGLES shingles; its
    set goes once to each block, however many partners it has.
    """
    sized = pairs.join(sizes.select(F.col("node").alias("b"), "n"), "b")
    blocks = sized.groupBy("a").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    partners = sized.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"))
    partners = partners.join(sets.withColumnRenamed("node", "b"), "b")
    partners = partners.select(F.col("a").alias("of"), F.col("block").alias("of_block"), F.col("b").alias("partner"), F.col("shingles").alias("theirs"))
    pivots = blocks.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(sets.withColumnRenamed("node", "a"), "a")
    schema = pa.schema([(c, pa.int64()) for c in ("a", "b", "shared", "total")])

    def measure(pivot, others):
        if not others.num_rows or not pivot.num_rows:
            return schema.empty_table()
        mine = np.sort(pivot.column("shingles")[0].values.to_numpy())
        lists = others.column("theirs").combine_chunks()
        values, cuts = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        hit = mine[np.minimum(np.searchsorted(mine, values), len(mine) - 1)] == values
        before = np.concatenate([[0], np.cumsum(hit)])
        shared = before[cuts[1:]] - before[cuts[:-1]]
        total = np.diff(cuts) + len(mine) - shared
        return pa.table([pa.array(np.full(len(shared), pivot.column("a")[0].as_py())), others.column("partner"), pa.array(shared), pa.array(total)], schema=schema)

    both = pivots.groupBy("a", "block").cogroup(partners.groupBy("of", "of_block"))
    return both.applyInArrow(measure, "a bigint, b bigint, shared bigint, total bigint")


def components(links: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(node, label): the smallest node of each component of ``links`` (a, b).

    With ``keys`` (node, key) nodes are ordered by key first, and a third column
    ``key`` holds the key of the component's smallest node, so that nobody need
    look it up by label. Labels spread to neighbours and then jump to their own
    label's label, so a chain's length halves in each round; every round is
    stored, and the labels that very many nodes have are seen in that pass.
    """
    spark = links.sparkSession
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "jaccard-links")
    nodes = both.select(F.col("a").alias("node")).distinct()
    nodes = nodes.withColumn("key", F.lit(0)) if keys is None else nodes.join(keys, "node")
    labels = last = stored(nodes.select("node", F.struct("key", "node").alias("label")), "jaccard-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        seen = Observation("labels")
        lower = stored(observe_keys(lower.withColumn("of", F.col("next.node")), ["of"], seen), "jaccard-near")
        jump = labels.select(F.col("node").alias("of"), F.col("label").alias("jumped"))
        moved = spread_join(lower, jump, ["of"], "inner", observed_keys(spark, seen))
        moved = stored(moved.select("node", "label", F.least("next", "jumped").alias("next")), "jaccard-labels")
        discard(lower, last)
        changed, last = moved.filter("label <> next").limit(1).count(), moved
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            discard(both)
            found = labels.select("node", F.col("label.node").alias("label"), F.col("label.key").alias("key"))
            return found.drop("key") if keys is None else found


def linked(found: DataFrame, percent: int) -> DataFrame:
    return found.filter(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")


def link_cells(cells: np.ndarray, source: np.ndarray, target: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (row, row) that join the cells of ``source`` rows to those of ``target`` rows.

    ``cells``: each row's cell number. Of the links between two cells one is
    returned. Distances from a pivot to all rows come from one look into an
    inverted index of the shingles.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    every = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    _, number, uses = np.unique(every, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    many = uses[number] > 1
    number, owner = number[many], owner[many]
    order = np.argsort(number, kind="stable")
    holders, start = owner[order], np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(uses)))])
    own = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sets)))])
    cells, links, windows = cells.copy(), [], []
    for z in np.flatnonzero(source).tolist():
        other = target & (cells != cells[z]) & (100 * np.minimum(sizes, sizes[z]) >= percent * np.maximum(sizes, sizes[z]))
        for away in windows:
            other &= np.abs(away - away[z]) <= 1 - percent / 100 + 1e-9
        if not other.any():
            continue
        mine = number[own[z] : own[z + 1]]
        counts = start[mine + 1] - start[mine]
        at = np.repeat(start[mine] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        total = sizes + sizes[z] - shared
        if len(windows) < WINDOW_PIVOTS:
            windows.append(1 - shared / total)
        for y in np.flatnonzero(other & (100 * shared >= percent * total)).tolist():
            if cells[y] != cells[z]:
                links.append((z, y))
                cells[cells == cells[y]] = cells[z]
    return links


def open_links(members: DataFrame, labels: DataFrame, sizes: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Stored links (a, b) between the cells of all regions that hold several.

    A document shares ``least_shared`` regions with a partner, so without as many less one of its
    largest regions it still shares one: those are all that it needs to be
    looked up in, and of two documents it is enough that the one in the smaller
    cell is. Regions in which nobody is looked up are left out.

    Regions that hang together through their pivots are one. Of such a one,
    documents outside the largest cell are dealt into blocks as sources and all
    documents into blocks as targets; each pair of a source and a
    target block is one group, so a group is bounded and a very large
    region is many groups. Where it is many, sources of one size class meet only
    targets of their own and the two classes beside it: the others are too
    small or too large for a link.
    """
    seen = Observation("cells")
    at = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = at = stored(observe_keys(at, ["label"], seen), "jaccard-labelled")
    cells = at.select("node", "label").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("cell"))
    larger = Window.partitionBy("node").orderBy(F.desc("documents"), "shingle").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a row counts with all regions that are like it; the largest ones may be passed over
    rows = spread_join(at, cells, ["label"], "inner", observed_keys(at.sparkSession, seen)).join(sizes, "node").withColumn("looked_up", F.sum("alike").over(larger) > least_shared(F.col("n"), percent) - 1)
    order = F.struct("cell", "label")
    several = rows.groupBy("shingle").agg(F.max(order).alias("last"), F.min(F.when(F.col("looked_up"), order)).alias("first"))
    at = stored(rows.join(several.filter("first < last").select("shingle"), "shingle").select("shingle", "node", "pivot", "label"), "jaccard-open")
    whole = components(at.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    rows = at.select("node", F.col("label").alias("cell")).distinct().join(whole.withColumnRenamed("label", "region"), "node").join(sizes, "node")
    rows = stored(rows, "jaccard-cells")
    discard(labelled, at)
    cells = rows.groupBy("region", "cell").agg(F.sum("n").alias("n"))
    largest = cells.groupBy("region").agg(F.max(F.struct("n", "cell")).alias("top"), F.sum("n").alias("all"))
    blocks = largest.select(
        "region", F.col("top.cell").alias("largest"),
        F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int").alias("target_blocks"),
        F.greatest(F.ceil((F.col("all") - F.col("top.n")) / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("source_blocks"),
    )
    dealt = rows.join(blocks, "region").withColumns({"hash": F.xxhash64("node"), "minor": F.col("cell") != F.col("largest"), "size": F.lit(0).cast("bigint")})

    def spread(df: DataFrame, own: str, other: str, source: F.Column, target: bool) -> DataFrame:
        """Each row in its own block, against every block of the other kind."""
        mine, every = F.pmod("hash", f"{own}_blocks"), F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        roles = [source.alias("source"), F.lit(target).alias("target")]
        return df.select("region", "size", "node", "cell", *roles, mine.cast("int").alias(f"{own}_block"), every.alias(f"{other}_block"))

    # where one group holds the whole region, a row takes both parts
    one = F.col("source_blocks") * F.col("target_blocks") == 1
    small, large = dealt.filter(one), size_classes(dealt.filter(~one).drop("source_blocks", "target_blocks"), percent)
    blocks = size_blocks(large)
    beside = large.withColumn("size", F.explode(_classes_beside()))
    both = (
        spread(small, "target", "source", F.col("minor"), True)
        .unionByName(spread(large.filter("minor").join(blocks, ["region", "size"]), "source", "target", F.lit(True), False))
        .unionByName(spread(beside.join(blocks, ["region", "size"]), "target", "source", F.lit(False), True))
        .join(shingles, "node")
    )

    def link(frame):
        import pandas as pd

        _, cells = np.unique(frame["cell"].to_numpy(), return_inverse=True)
        sets = [np.asarray(s, dtype=np.int64) for s in frame["shingles"]]
        found = link_cells(cells, frame["source"].to_numpy(dtype=bool), frame["target"].to_numpy(dtype=bool), sets, percent)
        nodes = frame["node"].to_numpy()
        return pd.DataFrame({"a": [nodes[a] for a, _ in found], "b": [nodes[b] for _, b in found]}, dtype="int64")

    found = stored(both.groupBy("region", "size", "source_block", "target_block").applyInPandas(link, "a bigint, b bigint"), "jaccard-open-links")
    discard(rows)
    return found


def size_classes(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` with ``size``: sets whose numbers of shingles ``n`` allow a link differ by one class at most."""
    return rows.withColumn("size", F.floor(F.log("n") / (math.log(100 / percent) + 1e-6)).cast("bigint"))


def _classes_beside() -> F.Column:
    return F.array(*[F.col("size") + i for i in (-1, 0, 1)])


def size_blocks(rows: DataFrame) -> DataFrame:
    """(region, size, source_blocks, target_blocks) of the size classes that hold sources (``minor``)."""
    classes = rows.groupBy("region", "size").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("minor"), F.col("n"))).alias("sources"))
    targets = classes.select("region", F.explode(_classes_beside()).alias("size"), "n").groupBy("region", "size").agg(F.sum("n").alias("targets"))
    count = lambda c: F.ceil(F.col(c) / BLOCK_SHINGLES).cast("int").alias(c[:-1] + "_blocks")
    return classes.filter("sources is not null").join(targets, ["region", "size"]).select("region", "size", count("sources"), count("targets"))


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id of its component).

    Null text or no words: no shingles, linked with nothing. Rows with equal sets
    are linked whatever their ids; a null id never names a component unless all
    its rows have one. Other columns are ignored.
    """
    seen = Observation("sets")
    named, rank = name_sets(docs, size, key, text, seen)
    first = F.struct(F.col("_key").isNull().alias("none"), F.coalesce("_key", F.lit(0)).alias("id"))
    rows = _components(docs, named, rank, seen, first, size, percent, text)
    component = F.when(~F.col("smallest.none"), F.col("smallest.id"))
    full = rows.select(F.col("_key").alias("doc_id"), "n_shingles", component.alias("component_id"))
    empty = named.filter("n_shingles = 0")
    return full.unionByName(empty.select(F.col("_key").alias("doc_id"), "n_shingles", F.col("_key").alias("component_id")))


def _components(docs: DataFrame, named: DataFrame, rank: np.ndarray, seen: Observation, first: F.Column, size: int, percent: int, text: str) -> DataFrame:
    """(_key, text_hash, n_shingles, smallest) of all rows with shingles; ``smallest``: the least ``first`` of the row's component."""
    sets = named.filter("n_shingles > 0")
    nodes = stored(sets.groupBy("node").agg(F.first("n_shingles").alias("n"), F.min(first).alias("key")), "jaccard-nodes")
    sizes = nodes.select("node", "n")
    rows = regions(docs, rank, size, percent, text)
    members = shared_regions(rows, sizes, percent)
    pairs = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()  # a star for each region
    todo = stored(_size_window(pairs, sizes, percent), "jaccard-pairs")
    shared = stored(members.select("node").distinct(), "jaccard-shared")
    shingles = candidate_sets(docs, named, shared, size, text)
    measured = stored(linked(distances(todo, shingles, sizes), percent), "jaccard-distances")
    discard(todo, shared)
    further = open_links(members, components(measured), sizes, shingles, percent)
    discard(members, shingles)
    labels = components(measured.unionByName(further), nodes.select("node", "key")).select("node", F.col("key").alias("smallest"))
    discard(measured, further)
    of_node = nodes.join(labels, "node", "left").select("node", F.coalesce("smallest", "key").alias("smallest"))
    return spread_join(sets, of_node, ["node"], "inner", observed_keys(docs.sparkSession, seen)).select("_key", "text_hash", "n_shingles", "smallest")


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of each component with the smallest id (ties: of repeated ids one row stays); rows without words all stay.

    A row with a null id stays only where its whole component has none: of such
    a component one row stays. Texts are shuffled once.
    """
    columns = docs.columns
    seen = Observation("sets")
    named, rank = name_sets(docs, size, key, text, seen)
    first = F.struct(F.col("_key").isNull().alias("_null"), F.coalesce("_key", F.lit(0)).alias("_id"), F.col("text_hash").alias("_hash"))
    rows = _components(docs, named, rank, seen, first, size, percent, text)
    chosen = stored(rows.select("smallest.*").distinct(), "jaccard-kept")
    words = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    parts = {"_null": F.col(key).isNull(), "_id": F.coalesce(F.col(key).cast("bigint"), F.lit(0)), "_hash": F.xxhash64(text)}
    # equal rows (id and text) are one choice, of which one stays; join and choice share one shuffle
    kept = docs.filter(words).withColumns(parts).join(chosen, list(parts), "left_semi").dropDuplicates(list(parts))
    return kept.select(*columns).unionByName(docs.filter(~words))


def _size_window(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow a link: the smaller at least ``percent`` of the larger."""
    with_sizes = pairs.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
    return with_sizes.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent).select("a", "b")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (5-word shingles, similarity 0.75)."""
    return near_duplicates(table(spark, sf_dir, "documents"))
