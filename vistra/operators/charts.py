"""Chart tables derived from the monthly aggregate (never from raw visits)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistra.functions.dates import period_label
from vistra.operators.aggregate import sort_for_display


def visits_per_year(monthly: DataFrame, ordered: bool = True) -> DataFrame:
    """Series for 'visits per year': monthly counts summed per year."""
    out = monthly.groupBy("visit_year").agg(F.sum("visit_count").cast("bigint").alias("visit_count"))
    return sort_for_display(out, ordered, "visit_year")


def mean_visits_per_month(monthly: DataFrame, ordered: bool = True) -> DataFrame:
    """Mean of the monthly totals per calendar month over the years present."""
    out = monthly.groupBy("visit_month").agg(F.avg("visit_count").alias("mean_visit_count"))
    return sort_for_display(out, ordered, "visit_month")


def duration_by_period(monthly: DataFrame, ordered: bool = True) -> DataFrame:
    """Average duration per ``YYYY-MM`` period, in time order."""
    out = monthly.select(
        period_label("visit_year", "visit_month").alias("period"),
        "visit_year",
        "visit_month",
        "avg_duration_days",
    )
    return sort_for_display(out, ordered, "visit_year", "visit_month")
