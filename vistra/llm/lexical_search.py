"""Ranked lexical search with bag deduplication.

Documents are restricted to the terms that occur in any item: a document's bag
is its sorted list of (term, occurrences) over that vocabulary, and m its length
norm. Scores depend on bag and m alone, so rows with an equal bag and an equal m
are one class. Classes are grouped by a hash of both and by both themselves,
which verifies the hash; each class is scored once, under its smallest
doc_id. The best documents of an item lie in the best ``k`` classes by (score,
smallest id): any further class has ``k`` documents before its first one. Only
those classes are expanded, by ascending doc_id, each to its first ``k`` members.

Bags come from one pass over the texts, without a shuffle. Shuffled are bags
with at least one item term, once for the classes; hot classes are counted
before the shuffle and cut to their first ``k`` members on the map side.

Items travel to the tasks: blocks of at most ``BLOCK_CHARS`` characters of item
text each, checked before anything is sent; a larger set of items is searched
block by block, each against all documents.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistra.llm.common import stored, table, texts_of, trimmed

TOP = 20
# Characters of item text in one block: bounds vocabulary and items that travel.
BLOCK_CHARS = 16_000_000
# Scores of one batch held at a time (classes x items) and terms of a batch's expansion.
SCORE_CELLS = 2_000_000
EXPANDED = 4_000_000

# Bytes that separate terms become blanks, A-Z becomes a-z; bytes from 0x80 on belong to letters.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z lower-cased; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def bags(docs: DataFrame, vocabulary: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored rows (doc_id, n, terms, times) of the documents with a term: ``n`` counts
    all terms, ``terms`` are ascending places in the sorted ``vocabulary``."""
    places = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])

    def count(batches):
        find = places.value.get
        for batch in batches:
            n, at, terms, times = [], [0], [], []
            for t in texts_of(batch, "_text"):
                words = terms_of(t)
                found = Counter(map(find, words))
                found.pop(None, None)
                n.append(len(words))
                at.append(at[-1] + len(found))
                order = sorted(found)
                terms.extend(order)
                times.extend(map(found.__getitem__, order))
            offsets = pa.array(at, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in ((terms, pa.int32()), (times, pa.int64()))]
            rows = pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(n, pa.int64()), *lists], schema=schema)
            yield rows.filter(pa.array([x > 0 for x in n]))

    source = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))
    return stored(source.mapInArrow(trimmed(count), "doc_id bigint, n bigint, terms array<int>, times array<bigint>"), "search-bags")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def best_classes(classes: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """(item, class, m, first, score): each task's ``k`` best classes of every item.

    ``items``: number, terms and the weight of each (times its repeats). A
    batch's (class, term) pairs meet the postings of the items; sums of whole
    numbers below 2**53 are exact in doubles.
    """
    term = np.concatenate([t for _, t, _ in items]) if items else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(items)), [len(t) for _, t, _ in items]).astype(np.int64)
    value = np.concatenate([w for _, _, w in items]) if items else np.zeros(0, np.int64)
    order = np.argsort(term, kind="stable")
    size = int(term.max()) + 1 if len(term) else 0
    start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=size))]).astype(np.int64)
    postings = classes.sparkSession.sparkContext.broadcast((owner[order], value[order], start, [i for i, _, _ in items]))
    schema = pa.schema([(c, pa.int64()) for c in ("item", "class", "m", "first", "score")])

    def parts(lengths: np.ndarray, work: np.ndarray, width: int):
        """Runs of rows within both bounds, one row at least."""
        at, cells, held = 0, 0, 0
        for i in range(len(lengths)):
            if i > at and (cells + width > SCORE_CELLS or held + work[i] > EXPANDED):
                yield at, i
                at, cells, held = i, 0, 0
            cells, held = cells + width, held + work[i]
        if at < len(lengths):
            yield at, len(lengths)

    def score(batches):
        owner, value, start, numbers = postings.value
        width = len(numbers)
        if not width:
            return
        best: np.ndarray = np.zeros((0, 6), np.int64)  # item, -score, first is null, first, class, m
        for batch in batches:
            lists = batch.column("terms")
            cuts = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            terms = lists.flatten().to_numpy().astype(np.int64)
            times = batch.column("times").flatten().to_numpy().astype(np.int64)
            m = batch.column("m").to_numpy().astype(np.int64)
            hashes = batch.column("class").to_numpy()
            firsts = batch.column("first")
            lacking, first = np.asarray(firsts.is_null()), firsts.fill_null(0).to_numpy()
            row = np.repeat(np.arange(len(m)), np.diff(cuts))
            impact = (1_000_000_000 * times) // (1000 * times + 12 * m[row])
            uses = start[terms + 1] - start[terms]
            work = np.concatenate([[0], np.cumsum(uses)])[cuts]
            found = []
            for a, b in parts(np.diff(cuts), np.diff(work), width):
                s = slice(cuts[a], cuts[b])
                n = uses[s]
                place = np.repeat(start[terms[s]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                cell = np.repeat(row[s] - a, n) * width + owner[place]
                total = np.bincount(cell, weights=(np.repeat(impact[s], n) * value[place]).astype(np.float64), minlength=(b - a) * width)
                total = total.reshape(b - a, width)
                if b - a > 4 * k:  # what is below an item's k-th best here is not among its best
                    low = np.partition(total, b - a - k, axis=0)[b - a - k]
                    hit = np.nonzero((total >= low) & (total > 0))
                else:
                    hit = np.nonzero(total > 0)
                r = hit[0] + a
                found.append(np.stack([hit[1], -total[hit].astype(np.int64), lacking[r].astype(np.int64), first[r], hashes[r], m[r]], axis=1))
            best = _first_of_each(np.concatenate([best, *found]), k)
        if len(best):
            names = np.array(numbers, np.int64)[best[:, 0]]
            columns = [pa.array(names), pa.array(best[:, 4]), pa.array(best[:, 5]), pa.array(best[:, 3], mask=best[:, 2] == 1), pa.array(-best[:, 1])]
            for at in range(0, len(best), 50_000):
                yield pa.RecordBatch.from_arrays([c[at : at + 50_000] for c in columns], schema=schema)

    return classes.mapInArrow(trimmed(score), "item bigint, class bigint, m bigint, first bigint, score bigint")


def _first_of_each(rows: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` rows of each value of the first column, in order of all columns."""
    rows = rows[np.lexsort(rows.T[::-1])]
    begins = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
    rank = np.arange(len(rows)) - np.repeat(begins, np.diff(np.append(begins, len(rows))))
    return rows[rank < k]


def _search_block(bagged: DataFrame, items: dict[int, Counter], vocabulary: list[bytes], k: int) -> DataFrame:
    totals = bagged.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    held = {r["term"]: r["held"] for r in bagged.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("held")).collect()}
    weights = {t: weight(totals["documents"], held.get(i, 0)) for i, t in enumerate(vocabulary)}
    place = {t: i for i, t in enumerate(vocabulary)}
    wanted = [
        (item, np.array([place[t] for t in c], np.int64), np.array([times * weights[t] for t, times in c.items()], np.int64))
        for item, c in sorted(items.items())
    ]
    shaped = bagged.filter(F.size("terms") > 0).select(
        "doc_id", "terms", "times",
        F.expr(f"75L + (25L * n * {totals['documents']}L) div {max(totals['terms'], 1)}L").alias("m"),
    ).withColumn("class", F.xxhash64("terms", "times", "m"))
    classes = shaped.groupBy("class", "m", "terms", "times").agg(F.min("doc_id").alias("first"))
    best = best_classes(classes, wanted, k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"), "class"))
    best = stored(best.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank"), "search-classes")
    # at most k classes an item: their hashes travel; whole bags tell members of unlike classes apart
    chosen = best.select("class", "m").distinct().hint("broadcast")
    members = shaped.join(chosen, ["class", "m"], "left_semi")
    same_bag = Window.partitionBy("class", "m", "terms", "times")
    members = members.withColumn("place", F.row_number().over(same_bag.orderBy(F.asc_nulls_last("doc_id")))).filter(F.col("place") <= k)
    members = members.withColumn("first", F.first("doc_id").over(same_bag.orderBy("place")))
    scored = best.select("item", "score", F.col("class").alias("of"), F.col("m").alias("of_m"), F.col("first").alias("of_first"))
    same = (F.col("class") == F.col("of")) & (F.col("m") == F.col("of_m")) & F.col("first").eqNullSafe(F.col("of_first"))
    found = members.join(scored.hint("broadcast"), same).select("item", "doc_id", "score")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    found = found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
    return found.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Each item's ``k`` documents of highest score above 0: item_id, rank (from 1), doc_id, score.

    Equal scores stand by ascending doc_id, a null id last. Null and empty texts
    have no terms: such a document is not counted, such an item finds nothing,
    and neither does one with a null id. Rows that repeat an item id are one
    item with the terms of all; rows that repeat a doc_id are documents of
    their own. Other columns are ignored. No items or no documents: no rows.
    """
    spark = docs.sparkSession
    source = items.select(F.col(item_key).cast("bigint").alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("_text")).filter("item is not null")
    total = source.agg(F.coalesce(F.sum(F.length("_text") + 32), F.lit(0)).alias("chars")).first()["chars"]
    blocks = 1 + int(2 * total // block_chars)
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    heaviest = source.groupBy(block).agg(F.sum(F.length("_text") + 32).alias("chars")).agg(F.max("chars")).first()[0] or 0
    if blocks > 1 and heaviest > block_chars:
        raise ValueError(f"an item's text holds {heaviest} characters: more than block_chars")
    out = []
    for b in range(blocks):
        counted: dict[int, Counter] = {}
        for r in source.filter(block == b).collect():
            counted.setdefault(r["item"], Counter()).update(terms_of(r["_text"]))
        vocabulary = sorted(set().union(*counted.values())) if counted else []
        if vocabulary:
            out.append(_search_block(bags(docs, vocabulary, key, text), counted, vocabulary, k))
    if not out:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    found = out[0]
    for part in out[1:]:
        found = found.unionByName(part)
    return found


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
