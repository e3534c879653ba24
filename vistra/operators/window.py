"""Ranking months within each year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vistra.operators.aggregate import sort_for_display


def ranked_months(monthly: DataFrame) -> DataFrame:
    """Dense rank of months by visit count (desc) inside each year.

    Runs on the monthly aggregate (≤ 12 rows per year), partitioned by year.
    """
    w = Window.partitionBy("visit_year").orderBy(F.col("visit_count").desc())
    return monthly.withColumn("month_rank", F.dense_rank().over(w))


def top_months(monthly: DataFrame, n: int = 3, ordered: bool = True) -> DataFrame:
    """Months with one of the ``n`` highest distinct counts per year.

    Ties share a rank, so a year may return more than ``n`` months. Spark plans
    the rank filter as a WindowGroupLimit before and after the shuffle.
    """
    top = ranked_months(monthly).filter(F.col("month_rank") <= n)
    return sort_for_display(top, ordered, "visit_year", "month_rank", "visit_month")
