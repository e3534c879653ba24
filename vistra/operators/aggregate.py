"""Aggregations over visits: monthly, yearly, demographic, global counts.

The aggregates group on low-cardinality keys (year, month, gender), so
Spark's partial (map-side) aggregation shrinks each input partition to a few
hundred rows before the shuffle; a hot key costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_visits(valid: DataFrame) -> DataFrame:
    """Per (year, month): visit count and mean duration in days."""
    return valid.groupBy("visit_year", "visit_month").agg(
        F.count("visit_occurrence_id").alias("visit_count"),
        F.avg("visit_duration_days").alias("avg_duration_days"),
    )


def sort_for_display(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    """Sort for display. Writers pass ``ordered=False``: a global sort of a
    result costs a sampling job and a shuffle, and files keep no order."""
    return df.orderBy(*keys) if ordered else df


def yearly_visits(valid: DataFrame, ordered: bool = True) -> DataFrame:
    """Per year: count of valid visits (the engines' comparison query)."""
    out = valid.groupBy("visit_year").agg(F.count("visit_occurrence_id").alias("visit_count"))
    return sort_for_display(out, ordered, "visit_year")


def yearly_rows(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Per year: row count over all clean visits, no duration filter."""
    out = (
        clean.filter(F.col("visit_year").isNotNull())
        .groupBy("visit_year")
        .agg(F.count(F.lit(1)).alias("visit_count"))
    )
    return sort_for_display(out, ordered, "visit_year")


def visit_count(valid: DataFrame, name: str = "valid_visits") -> DataFrame:
    """Global row count as a one-row DataFrame."""
    return valid.agg(F.count(F.lit(1)).alias(name))


def visits_by_gender(valid: DataFrame, person: DataFrame, ordered: bool = True) -> DataFrame:
    """Visit count per gender over visits LEFT JOIN person; NULL gender is a group.

    Visits are counted per person before the join, so a person holding a third
    of all visits is one row per map task, and counts are summed per gender
    after it. The answer is that of joining first: a count distributes over
    the left join, duplicated person ids included.
    """
    per_person = valid.groupBy("person_id").agg(F.count("visit_occurrence_id").alias("n_visits"))
    summary = (
        per_person.join(person.select("person_id", "gender_source_value"), "person_id", "left")
        .groupBy("gender_source_value")
        .agg(F.sum("n_visits").cast("bigint").alias("visit_count"))
    )
    return sort_for_display(summary, ordered, F.desc("visit_count"), F.asc_nulls_last("gender_source_value"))
