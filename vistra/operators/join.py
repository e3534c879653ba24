"""Joins that hold when one key has a third of all rows.

``spread_join`` finds the heavy keys of the large side by a bounded sketch over
its key column, deals the rows of such a key over several salts, and repeats
the few rows of the other side that hold it, once a salt. Nothing depends on
thresholds of the adaptive skew join. The heavy keys are a table of at most
``MOST_HEAVY`` rows, broadcast to both sides. They come from a pass over the key
columns, or from the pass that computes the large side anyway: ``observe_keys``
lets the sketch run along with a write, and ``observed_keys`` reads it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A key is heavy from this share of the rows on, so there are fewer than 1 / share.
HEAVY_SHARE = 1 / 500
MOST_HEAVY = 500
# Keys that the sketch follows: it misses a count by some total / 5,000 at most, a tenth of a heavy one.
SKETCH_KEYS = 10_000
# A salt of a heavy key holds about this share of the rows.
SALT_SHARE = 1 / 1000


def _sketch(on: Sequence[str]) -> list[Column]:
    """The most frequent keys (by hash) and the number of rows with a key."""
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    top = F.call_function("approx_top_k", F.when(known, F.xxhash64(*on)), F.lit(MOST_HEAVY), F.lit(SKETCH_KEYS))
    return [top.alias("top"), F.count_if(known).alias("rows")]


def _heavy(top: DataFrame) -> DataFrame:
    """(rows, __heavy_key, times) -> (__heavy_key, __heavy_salts) of the heavy ones."""
    heavy = top.filter(F.col("__heavy_key").isNotNull() & (F.col("times") >= F.col("rows") * HEAVY_SHARE))
    return heavy.select("__heavy_key", F.ceil(F.col("times") / (F.col("rows") * SALT_SHARE)).cast("int").alias("__heavy_salts"))


def heavy_keys(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """(__heavy_key, __heavy_salts) of the keys with a share of at least HEAVY_SHARE; keys by hash, nulls left out."""
    return _heavy(rows.agg(*_sketch(on)).select("rows", F.inline("top")).toDF("rows", "__heavy_key", "times"))


def observe_keys(rows: DataFrame, on: Sequence[str], seen: Observation) -> DataFrame:
    """``rows``, whose keys are sketched while an action computes them."""
    return rows.observe(seen, *_sketch(on))


def observed_keys(spark: SparkSession, seen: Observation) -> DataFrame:
    """``heavy_keys`` from a finished observation."""
    found = seen.get
    rows = [(found["rows"], r["item"], r["count"]) for r in found["top"] or []]
    return _heavy(spark.createDataFrame(rows, "rows bigint, __heavy_key bigint, times bigint"))


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", heavy: DataFrame | None = None) -> DataFrame:
    """``left`` joined with ``right`` (inner or left) on equal columns ``on``, heavy keys of ``left`` dealt over salts.

    A row's salt follows from a hash of all its columns, so a task that is run
    again deals alike. Rows with a null key match nothing and are dealt likewise.
    ``heavy``: what ``heavy_keys`` gives for ``left``, where it is known already.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    heavy = (heavy_keys(left, on) if heavy is None else heavy).hint("broadcast")
    empty = F.lit(False)
    for c in on:
        empty = empty | F.col(c).isNull()
    row = F.xxhash64(*left.columns)
    salts = F.when(empty, F.lit(int(1 / SALT_SHARE))).otherwise(F.coalesce("__heavy_salts", F.lit(1)))
    dealt = left.withColumn("__heavy_key", F.xxhash64(*on)).join(heavy, "__heavy_key", "left")
    dealt = dealt.withColumn("__heavy_salt", F.when(salts > 1, F.pmod(row, salts)).otherwise(F.lit(0)).cast("int"))
    dealt = dealt.select(*left.columns, "__heavy_salt")
    repeated = right.withColumn("__heavy_key", F.xxhash64(*on)).join(heavy, "__heavy_key", "left")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("__heavy_salts", F.lit(1)) - 1)).alias("__heavy_salt")
    repeated = repeated.select(*right.columns, every)
    return dealt.join(repeated, [*on, "__heavy_salt"], how).drop("__heavy_salt")


def visits_person_left(valid: DataFrame, person: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Every visit kept; unknown person → NULL attributes."""
    return spread_join(valid, person, ["person_id"], "left", heavy)
