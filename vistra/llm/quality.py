"""Quality rules: an isolation forest over rule statistics, with a labelled threshold.

Every document gets counts by plain rules. A forest of random splits isolates
rows by their statistics: rare combinations end in short paths, so a short mean
path marks an anomaly. All rows that pass the base rules are dealt over the trees, and
those of a tree over groups of some 64, which share its splits: whether a node is split and by what
goes by the share of its groups that would do so, the range is the mean of theirs, and a path ends
by the mean of what the others would still take.
So every row has its part in a forest of bounded size, and rare rows stay rare. The cut is calibrated on all labelled rows: of the cuts that
reject at most ``GOOD_LOSS`` of the good ones, that which rejects most bad ones.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import Words, in_groups, stored, table, texts_of, trimmed

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

TREES = 200
# Rows of a group, and those that a tree gets at least (all, if fewer): a small table's rows are dealt to several trees each.
TREE_ROWS = 64
# Levels of splits in a tree; with TREES it bounds the model whatever the number of rows.
DEPTH = 6
GOOD_LOSS = 0.002
# Labelled good and bad rows that a calibration needs; with fewer, the forest
# rejects nothing.
LEAST_LABELS = 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits"]
_CLASSES = {"n_symbols": SYMBOLS, "n_upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "n_digits": b"0123456789"}


def repeated_words(words: Words, n: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in an n-word window found twice or more in it."""
    count = np.diff(words.first)
    value, at, text = words.windows(n)
    key = value ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    twin = key[order][1:] == key[order][:-1]
    hit = np.zeros(len(key), dtype=bool)
    hit[order[1:][twin]] = True
    hit[order[:-1][twin]] = True
    edge = np.bincount(at[hit], minlength=len(words.hash) + 1)[: len(words.hash) + 1]
    edge = edge - np.bincount(at[hit] + n, minlength=len(words.hash) + 1)[: len(words.hash) + 1]
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[: len(words.hash)] > 0)])
    return covered[words.first[1:]] - covered[words.first[:-1]] if len(count) else count


def statistics(texts: list[str]) -> dict[str, np.ndarray]:
    """The rule counts of each text, by name."""
    parts = [_statistics(part) for part in in_groups(texts)] or [_statistics([])]
    return {c: np.concatenate([p[c] for p in parts]) for c in COUNTS}


def _statistics(texts: list[str]) -> dict[str, np.ndarray]:
    words = Words(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[words.text_at[1:]] - total[words.text_at[:-1]]

    buf = words.buf
    inside = np.ones(len(buf), dtype=bool)
    inside[np.isin(buf, np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))] = False
    out = {"n_words": np.diff(words.first), "word_chars": per_text(inside & ((buf & 0xC0) != 0x80))}
    for name, chars in _CLASSES.items():
        member = np.zeros(256, dtype=bool)
        member[list(chars)] = True
        out[name] = per_text(member[buf])
    lines = [[x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")] for t in texts]
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64)
    out["n_repeat_words"] = repeated_words(words)
    return {c: out[c].astype(np.int64) for c in COUNTS}


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rule_table(docs: DataFrame, keep: list[str] = (), key: str = "doc_id", text: str = "text", score=None) -> DataFrame:
    """Per row: ``_key``, the kept columns, the rule counts, with ``score`` also what it makes of them. No shuffle."""
    fields = [docs.schema[c] for c in keep]
    source = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"), *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    )

    def count(batches):
        for batch in batches:
            found = statistics(texts_of(batch, "_text"))
            names = ["_key", *(f"_keep{i}" for i in range(len(keep)))]
            out = pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(found[c]) for c in COUNTS], names=names + COUNTS)
            yield out if score is None else score(out)

    ddl = ["_key " + docs.schema[key].dataType.simpleString(), *(f"_keep{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)), *(f"{c} bigint" for c in COUNTS)]
    ddl += ["anomaly_score double"] if score else []
    return source.mapInArrow(trimmed(count), ", ".join(ddl))


def features(counts: np.ndarray) -> np.ndarray:
    """Counts (columns as in COUNTS) to the numbers that the forest splits on.

    Shares whose usual small variation says nothing are taken in steps of a
    tenth, so that only gross deviations give the forest something to split.
    """
    c = dict(zip(COUNTS, counts.astype(np.float64).T, strict=True))
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    coarse = [np.floor(10 * x) / 10 for x in (c["n_upper"] / chars, c["n_digits"] / chars, c["n_repeat_words"] / words)]
    return np.stack([c["n_symbols"] / words, c["word_chars"] / words, *coarse], axis=1)


FEATURES = ["symbols a word", "characters a word", "share of capitals", "share of digits", "share of repeated words"]


def _mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows in a random tree."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def copies_of(rows: int, trees: int = TREES, tree_rows: int = TREE_ROWS) -> int:
    """To how many trees each row is dealt: one, or as many as give each tree some ``tree_rows``."""
    return min(trees, max(1, -(-trees * tree_rows // max(rows, 1))))


def node_of(forest: dict[str, np.ndarray], tree: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The leaf that each row ends in, in a tree of its own."""
    at, every = forest["roots"][tree], np.arange(len(rows))
    while True:
        f = forest["feature"][at]
        going = f >= 0
        if not going.any():
            return at
        below = rows[every, np.maximum(f, 0)] <= forest["cut"][at]
        at = np.where(going, np.where(below, forest["left"][at], forest["right"][at]), at)


def grow_forest(node_ranges, size: float, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> dict[str, np.ndarray]:
    """A forest as flat arrays: feature (-1: leaf), cut, left child, right child, path length, tree roots.

    ``node_ranges(forest, first)``: of the leaves from number ``first`` on, over all rows dealt to
    the trees, (node, shares of the tree's groups that would split it by each feature, mean further path of
    those that would not split it and of all, lows and highs by feature); one call a level.
    ``size``: mean number of rows of a group.
    """
    rng = np.random.default_rng(seed)
    deepest = min(depth, math.ceil(math.log2(max(size, 2))))
    feature, cut, left, right = [-1] * trees, [0.0] * trees, [-1] * trees, [-1] * trees
    path = [0.0] * trees

    def forest() -> dict[str, np.ndarray]:
        return {
            "feature": np.array(feature, np.int32), "cut": np.array(cut), "left": np.array(left, np.int32), "right": np.array(right, np.int32),
            "path": np.array(path), "roots": np.arange(trees, dtype=np.int32), "usual": np.array(_mean_path(size) or 1.0),
        }

    first = 0
    for level in range(deepest + 1):
        level_first, first = first, len(feature)
        if level_first == first:
            break
        for node, share, ended, further, low, high in sorted(node_ranges(forest(), level_first)):
            if level == deepest or rng.random() >= sum(share):
                path[node] = level + (further if level == deepest else ended)
                continue
            f = int(rng.choice(len(share), p=np.array(share) / sum(share)))
            c = float(rng.uniform(low[f], high[f]))
            feature[node], cut[node] = f, c if c < high[f] else low[f]
            left[node], right[node] = len(feature), len(feature) + 1
            for store, value in ((feature, -1), (cut, 0.0), (left, -1), (right, -1), (path, level + 1.0)):
                store += [value, value]
    return forest()


def fit_forest(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> dict[str, np.ndarray]:
    """The forest of a few rows: as ``forest_of``, with one group a tree."""
    if not len(rows):
        return NO_FOREST
    copies = copies_of(len(rows), trees, tree_rows)
    tree = ((np.random.default_rng(seed).permutation(len(rows))[:, None] + np.arange(copies)) % trees).ravel()
    dealt = np.repeat(rows, copies, axis=0)

    def node_ranges(forest, first):
        at = node_of(forest, tree, dealt)
        found = []
        for n in np.unique(at[at >= first]):
            part = dealt[at == n]
            low, high = part.min(axis=0), part.max(axis=0)
            wide, further = high > low, _mean_path(len(part))
            found.append((int(n), (wide / max(wide.sum(), 1)).tolist(), further, further, low.tolist(), high.tolist()))
        return found

    return grow_forest(node_ranges, len(dealt) / trees, trees, seed=seed)


NO_FOREST = {"roots": np.zeros(0, np.int32)}


def forest_of(passed: DataFrame, key: str) -> dict[str, np.ndarray]:
    """The forest of all rows of ``passed``.

    Hashes of id and counts deal each row to one tree or more and to a group, whatever files hold it.
    A pass a level over the dealt numbers; what reaches the driver is a row for each node of that
    level. Means are taken of decimals, whose sums don't depend on the order.
    """
    total = passed.count()
    if not total:
        return NO_FOREST
    copies, sc = copies_of(total), passed.sparkSession.sparkContext
    groups = max(1, round(total * copies / TREES / TREE_ROWS))  # of a tree
    names = [f"f{i}" for i in range(len(FEATURES))]

    def number(batches):
        for batch in batches:
            found = features(np.stack([batch.column(c).to_numpy() for c in COUNTS], axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("_tree"), batch.column("_group"), *(pa.array(x) for x in found.T)], names=["_tree", "_group", *names])

    ddl = ", ".join(f"{n} double" for n in names)
    tree, group = (F.pmod(F.xxhash64(key, *COUNTS, F.lit(i)), F.lit(n)).cast("bigint") for i, n in enumerate((TREES, groups)))
    dealt = stored(passed.select(tree.alias("_tree"), group.alias("_group"), *COUNTS).mapInArrow(trimmed(number), f"_tree bigint, _group bigint, {ddl}"), "quality-forest")
    if copies > 1:
        dealt = dealt.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn("_tree", F.pmod(F.col("_tree") + F.col("_copy"), F.lit(TREES)))
    dealt = dealt.select(F.col("_tree").cast("bigint").alias("_tree"), "_group", *names)
    exact = lambda c: c.cast("decimal(38,15)")

    def node_ranges(forest, first):
        model = sc.broadcast(forest)

        def place(batches):
            for batch in batches:
                at = node_of(model.value, batch.column("_tree").to_numpy(), np.stack([batch.column(n).to_numpy() for n in names], axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), *(batch.column(c) for c in ("_group", *names))], names=["node", "_group", *names])

        placed = dealt.mapInArrow(trimmed(place), f"node bigint, _group bigint, {ddl}").filter(F.col("node") >= first)
        ends = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in names]
        by_group = placed.groupBy("node", "_group").agg(F.count(F.lit(1)).alias("n"), *ends)
        n, wide = F.col("n"), {c: F.col(f"max_{c}") > F.col(f"min_{c}") for c in names}
        n_wide = sum((w.cast("int") for w in wide.values()), F.lit(0))
        path = F.when(n <= 1, F.lit(0.0)).when(n == 2, F.lit(1.0)).otherwise(2 * (F.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n)
        by_group = by_group.withColumns({"n_wide": n_wide, "path": path})
        found = by_group.groupBy("node").agg(
            F.count_if(F.col("n_wide") > 0).alias("split"),
            *[F.coalesce(F.sum(exact(F.when(c, x))), F.lit(0)).cast("double").alias(k) for k, c, x in (("ended", F.col("n_wide") == 0, F.col("path")), ("further", F.lit(True), F.col("path")))],
            *[F.coalesce(F.sum(exact(F.when(w, 1 / F.col("n_wide")))), F.lit(0)).cast("double").alias(f"share_{c}") for c, w in wide.items()],
            *[F.avg(exact(F.when(w, F.col(f"{f}_{c}")))).cast("double").alias(f"{f}_{c}") for c, w in wide.items() for f in ("min", "max")],
        ).collect()
        model.unpersist()
        return [
            (r["node"], [r[f"share_{c}"] / groups for c in names], r["ended"] / max(groups - r["split"], 1), r["further"] / groups, *([r[f"{f}_{c}"] or 0.0 for c in names] for f in ("min", "max")))
            for r in found
        ]

    return grow_forest(node_ranges, total * copies / TREES / groups)


def anomaly(forest: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Scores in (0, 1): 2 ** -(mean path / usual path); higher is rarer."""
    if not len(forest["roots"]):
        return np.full(len(rows), 0.5)
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for root in forest["roots"]:
        at = np.full(len(rows), root)
        while True:
            f = forest["feature"][at]
            going = f >= 0
            if not going.any():
                break
            below = rows[every, np.maximum(f, 0)] <= forest["cut"][at]
            at = np.where(going, np.where(below, forest["left"][at], forest["right"][at]), at)
        total += forest["path"][at]
    return 2.0 ** -(total / len(forest["roots"]) / float(forest["usual"]))


def calibrate(scores: np.ndarray, good: np.ndarray, loss: float = GOOD_LOSS) -> float:
    """The lowest cut above which at most ``loss`` of the good rows lie; inf if labels are few."""
    if good.sum() < LEAST_LABELS or (~good).sum() < LEAST_LABELS:
        return math.inf
    fine = np.sort(scores[good])
    return float(fine[len(fine) - 1 - int(loss * len(fine))])


# Parts into which a round of ``kth_highest`` cuts the values that are left.
BINS = 1024


def kth_highest(df: DataFrame, column: str, k: int) -> float:
    """The value with ``k`` rows before it when all are sorted from the highest down, exactly.

    Each round counts the values in equal parts of the range that is left and goes on in the
    part that holds the place, until one value is left; BINS rows a round reach the driver.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low < high:
        left = df.filter(F.col(column).between(low, high))
        part = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
        found = left.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for r in sorted(found, reverse=True):
            if k < r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return low


def calibrated_cut(scored: DataFrame, loss: float = GOOD_LOSS) -> float:
    """``calibrate`` over all rows of ``scored`` (anomaly_score, _quality)."""
    good, bad = scored.agg(F.count_if(F.col("_quality") == 1), F.count_if(~F.col("_quality").eqNullSafe(1))).first()
    if good < LEAST_LABELS or bad < LEAST_LABELS:
        return math.inf
    return kth_highest(scored.filter("_quality = 1"), "anomaly_score", int(loss * good))


def scoring(rules: DataFrame, labels: DataFrame, key: str = "_key"):
    """(score, cut): a function that adds ``anomaly_score`` to a batch of ``rules``, and the highest score that is kept.

    The forest grows from all rows that pass the base rules and the cut is calibrated on all
    labelled ones among them (of repeated labels the lowest counts).
    """
    passed = rules.filter(~base_failed()).select(key, *COUNTS)
    model = rules.sparkSession.sparkContext.broadcast(forest_of(passed, key))  # TREES trees of at most 2 ** (DEPTH + 1) nodes

    def score(batch):
        rows = np.stack([batch.column(c).to_numpy() for c in COUNTS], axis=1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(anomaly(model.value, features(rows)))], names=[*batch.schema.names, "anomaly_score"])

    truth = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias(key)).agg(F.min("quality").alias("_quality"))
    return score, calibrated_cut(stored(scored(passed.join(truth, key), score).select("_quality", "anomaly_score"), "quality-labelled"))


def scored(rules: DataFrame, score) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield score(batch)

    return rules.mapInArrow(trimmed(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rules.schema) + ", anomaly_score double")


def quality_rules(docs: DataFrame, labels: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Every row of ``docs`` with its rule counts, ``anomaly_score``, ``base_failed`` and ``kept``, and the columns named in ``keep``.

    ``docs``: doc_id, text (null text: no words, base_failed). Null and repeated
    ids are rows of their own. ``labels``: doc_id, quality (1 good, 0 bad);
    empty or few labels: the base rules alone decide.

    Only counts are stored. Columns to keep may be as large as the input, so
    with them the rows are counted again as they are scored.
    """
    rules = stored(rule_table(docs), "quality-rules")
    score, cut = scoring(rules, labels)
    rows = rule_table(docs, list(keep), score=score) if keep else scored(rules, score)
    rows = rows.withColumn("base_failed", base_failed())
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly_score") <= F.lit(cut)))
    names = {"_key": "doc_id"} | {f"_keep{i}": c for i, c in enumerate(keep)}
    return rows.select(*[F.col(c).alias(names.get(c, c)) for c in rows.columns if not (c == "_key" and "doc_id" in keep)])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts for all documents."""
    found = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly_score")
