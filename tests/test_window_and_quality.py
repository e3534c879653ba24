"""Ranking ties, reconciliation, profile, sample."""

from pyspark.sql import functions as F

from vistra.operators import quality, window


def test_dense_rank_ties_return_more_than_three(spark):
    monthly = spark.createDataFrame(
        [(2000, m, c, 1.0) for m, c in zip(range(1, 7), [5, 5, 4, 3, 3, 1])],
        "visit_year int, visit_month int, visit_count long, avg_duration_days double",
    )
    rows = window.top_months(monthly).collect()
    assert len(rows) == 5
    assert [r.month_rank for r in rows] == [1, 1, 2, 3, 3]


def test_reconcile_reports_differences_and_one_sided_keys(spark):
    a = spark.createDataFrame([(1, 10), (2, 20), (None, 5)], "k int, v long")
    b = spark.createDataFrame([(1, 10), (2, 21), (3, 1), (None, 5)], "k int, v long")
    diff = quality.reconcile(a, b, ["k"], "v", "left_v", "right_v")
    assert sorted((r.k, r.left_v, r.right_v) for r in diff.collect()) == [(2, 20, 21), (3, None, 1)]
    try:
        quality.assert_reconciled(diff)
        raise AssertionError("should have raised")
    except quality.ReconciliationError:
        pass
    quality.assert_reconciled(quality.reconcile(a, a, ["k"], "v", "l", "r"))


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    rows = quality.table_profile({"t": df}).orderBy("ordinal").collect()
    assert [(r.column_name, r.data_type, r.row_count, r.non_nulls) for r in rows] == [
        ("a", "bigint", 2, 2), ("b", "string", 2, 1)]


def test_sample_rows_deterministic(spark):
    df = spark.range(100).repartition(7).withColumn("k", -F.col("id"))
    assert [r.id for r in quality.sample_rows(df, 3, ["k"]).collect()] == [99, 98, 97]


def test_checksum_order_insensitive(spark):
    df = spark.range(50).withColumn("v", F.col("id") * 3)
    a = quality.checksum(df).first()
    b = quality.checksum(df.repartition(5).orderBy(F.desc("id"))).first()
    assert a == b and a.rows == 50
