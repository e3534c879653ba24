"""Cleaning: raw text visits → typed visits; person text → person dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistra.functions.dates import clip_at_zero, duration_days, parse_texts, truncate_to_millis
from vistra.functions.numbers import parse_long, parse_person_id
from vistra.schema import (
    CLEAN_COLUMNS,
    MISSING_ID,
    MISSING_SOURCE,
    NA_TOKENS,
    PERSON_COLUMNS,
    VISIT_ID_COLUMNS,
)

REQUIRED = ["visit_occurrence_id", "person_id", "visit_start_datetime"]


def _timestamp(df: DataFrame, name: str) -> F.Column:
    """A time column that is not text."""
    if isinstance(df.schema[name].dataType, (T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    return F.col(name).cast("string").try_cast("timestamp_ntz")


def normalize_na_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn the reader's missing-value strings into NULL (exact match)."""
    cols = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    ]
    return df.select(
        *[
            F.when(F.col(c).isin(NA_TOKENS), F.lit(None)).otherwise(F.col(c)).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )


# What the cleaning counts on its way: of the rows read, those that lack a key value or whose text can't be read.
def _loss_counts() -> list[F.Column]:
    visit, person, start = (F.col(c).isNull() for c in REQUIRED)
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(visit).alias("no_visit_id"),
        F.count_if(person).alias("no_person_id"),
        F.count_if(start & ~F.col("__start_given")).alias("no_start"),
        F.count_if(start & F.col("__start_given")).alias("unreadable_start"),
        F.count_if(visit | person | start).alias("dropped"),
        F.count_if(~(visit | person | start) & F.col("__end_given") & F.col("visit_end_datetime").isNull()).alias("kept_unreadable_end"),
    ]


def loss_report(loss: Observation, visits: DataFrame) -> DataFrame:
    """(reason, rows) from what ``clean_visits`` observed; ``visits`` must have been computed in full.

    A dropped row is counted under each reason that it has.
    """
    found = loss.get
    return visits.sparkSession.createDataFrame([(k, int(v)) for k, v in found.items()], "reason string, rows bigint")


def clean_visits(raw: DataFrame, loss: Observation | None = None) -> DataFrame:
    """Raw visit rows → the 12-column clean visits table.

    Steps (all column expressions, so Catalyst prunes the unused raw columns
    and all of it runs in one stage):
    parse ids and times (bad → NULL); drop rows missing visit id, person id
    or start; fill provider/care site with -1 and source value with UNKNOWN;
    derive year, month and duration in days (computed at full precision,
    clipped below at 0, NULL when the end is missing); keep millisecond
    precision on the stored times. ``loss`` observes, in the same pass, how
    many rows are dropped and why.
    """
    types = {f.name: f.dataType for f in raw.schema.fields}
    texts = [c for c in ("visit_start_datetime", "visit_end_datetime") if isinstance(types[c], T.StringType)]
    times = ("visit_start_datetime", "visit_end_datetime")
    given = [F.col(c).isNotNull().alias(n) for c, n in zip(times, ("__start_given", "__end_given"))] if loss else []
    parsed = parse_texts(
        raw.select(
            *[parse_long(F.col(c), types[c]).alias(c) for c in VISIT_ID_COLUMNS],
            *[F.col(c) if c in texts else _timestamp(raw, c).alias(c) for c in times],
            F.col("visit_source_value").cast("string").alias("visit_source_value"),
            *given,
        ),
        texts,
    )
    if loss:
        parsed = parsed.observe(loss, *_loss_counts()).drop("__start_given", "__end_given")
    # a generator: a plain filter would be pushed below the parsing, which would then run twice
    whole = F.col(REQUIRED[0]).isNotNull() & F.col(REQUIRED[1]).isNotNull() & F.col(REQUIRED[2]).isNotNull()
    parsed = parsed.select(F.inline(F.when(whole, F.array(F.struct(*parsed.columns)))))

    start, end = F.col("visit_start_datetime"), F.col("visit_end_datetime")
    derived = {
        "visit_occurrence_id": F.col("visit_occurrence_id"),
        "person_id": F.col("person_id"),
        "visit_concept_id": F.col("visit_concept_id"),
        "visit_start_datetime": truncate_to_millis(start),
        "visit_end_datetime": truncate_to_millis(end),
        "visit_type_concept_id": F.col("visit_type_concept_id"),
        "provider_id": F.coalesce(F.col("provider_id"), F.lit(MISSING_ID).cast("bigint")),
        "care_site_id": F.coalesce(F.col("care_site_id"), F.lit(MISSING_ID).cast("bigint")),
        "visit_source_value": F.coalesce(F.col("visit_source_value"), F.lit(MISSING_SOURCE)),
        "visit_year": F.year(start),
        "visit_month": F.month(start),
        "visit_duration_days": clip_at_zero(duration_days(start, end)),
    }
    return parsed.select(*[derived[c].alias(c) for c in CLEAN_COLUMNS])


def valid_visits(clean: DataFrame) -> DataFrame:
    """Visits usable for analysis: duration known and ≥ 0, year known.

    After the clip no duration is negative, so this removes exactly the rows
    whose end time is missing.
    """
    return clean.filter((F.col("visit_duration_days") >= 0) & F.col("visit_year").isNotNull())


def fill_report(clean: DataFrame) -> DataFrame:
    """How many rows carry each fill value: (column_name, filled_rows)."""
    counts = clean.agg(
        F.count_if(F.col("provider_id") == MISSING_ID).alias("provider_id"),
        F.count_if(F.col("care_site_id") == MISSING_ID).alias("care_site_id"),
        F.count_if(F.col("visit_source_value") == MISSING_SOURCE).alias("visit_source_value"),
    )
    return counts.unpivot(
        [], ["provider_id", "care_site_id", "visit_source_value"], "column_name", "filled_rows"
    )


def person_dim(raw_person: DataFrame) -> DataFrame:
    """person text → (person_id BIGINT, gender, race); unparsable ids dropped."""
    return raw_person.select(
        parse_person_id(F.col("person_id")).alias("person_id"),
        F.col("gender_source_value").cast("string").alias("gender_source_value"),
        F.col("race_source_value").cast("string").alias("race_source_value"),
    ).filter(F.col("person_id").isNotNull()).select(*PERSON_COLUMNS)
