"""A person holding a third of all visits: results stay whole and equal."""

import contextlib
import statistics

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import SF001
from vistra.operators import aggregate
from vistra.operators.join import SALT_SHARE, heavy_keys, observe_keys, observed_keys, spread_join, visits_person_left
from vistra.plans import queries as Q


def test_hot_person(spark):
    valid = Q.valid_of(spark, SF001)
    n = valid.count()
    # every third visit moves to one existing person
    hot_id = Q.person_of(spark, SF001).agg(F.min("person_id")).first()[0]
    skewed = valid.withColumn(
        "person_id",
        F.when(F.xxhash64("visit_occurrence_id", "visit_concept_id", "visit_type_concept_id") % 3 == 0,
               F.lit(hot_id)).otherwise(F.col("person_id")),
    )
    person = Q.person_of(spark, SF001)
    joined = visits_person_left(skewed, person)
    assert joined.count() == n
    by_gender = {r.gender_source_value: r.visit_count for r in aggregate.visits_by_gender(skewed, person).collect()}
    assert by_gender == {r[0]: r[1] for r in joined.groupBy("gender_source_value").count().collect()}
    assert sum(by_gender.values()) == n


SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_by_task(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_hot_person_is_dealt_over_all_tasks(spark):
    """A third of the visits on one person, neither a broadcast nor the adaptive skew join: no task has 3 times the median's rows."""
    visits = spark.range(90_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("person_id"))
    person = spark.range(0, 5000, 2).select(F.col("id").alias("person_id"), F.concat(F.lit("p"), "id").alias("name"))
    with settings(spark, SETTINGS):
        plain = rows_by_task(visits.join(person, "person_id", "left"))
        dealt = rows_by_task(spread_join(visits, person, ["person_id"], "left"))
    assert max(plain) > 3 * statistics.median(plain)  # the case is skewed
    assert sum(dealt) == 90_000 and max(dealt) <= 3 * statistics.median(dealt)


def test_only_heavy_keys_rows_are_repeated(spark):
    visits = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("k"))
    heavy = {r["__heavy_key"]: r["__heavy_salts"] for r in heavy_keys(visits, ["k"]).collect()}
    hot = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert set(heavy) == {hot} and heavy[hot] >= 1 / 3 / SALT_SHARE
    seen = Observation("keys")
    observe_keys(visits, ["k"], seen).write.format("noop").mode("overwrite").save()
    assert {r["__heavy_key"]: r["__heavy_salts"] for r in observed_keys(spark, seen).collect()} == heavy


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_the_plain_join(spark, how):
    """Null keys, repeated rows on both sides, keys of two columns."""
    left = spark.range(3000).select(
        (F.col("id") % 7).alias("n"), F.when(F.col("id") % 5 != 0, F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))).alias("s"),
        (F.col("id") % 3).alias("v"),
    )
    right = spark.createDataFrame([(0, "hot", 1), (0, "hot", 2), (1, "hot", 3), (2, None, 4), (3, "3", 5), (3, "3", 5)], "n bigint, s string, w int")
    got = spread_join(left, right, ["n", "s"], how)
    want = left.join(right, ["n", "s"], how)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert spread_join(left.limit(0), right, ["n", "s"], how).count() == 0
    odd = left.withColumnsRenamed({"v": "_key"}).withColumn("_salt", F.lit(1))  # columns of any name
    assert sorted(spread_join(odd, right, ["n", "s"], how).collect(), key=repr) == sorted(odd.join(right, ["n", "s"], how).collect(), key=repr)
    with pytest.raises(ValueError):
        spread_join(left, right, ["n"], "full")
