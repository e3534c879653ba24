"""Column lists, schemas and fixed values of the visit data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: must equal the reference's input layout -----------------
# The 17 columns of the raw visit_occurrence CSV, in file order.
VISIT_COLUMNS = [
    "visit_occurrence_id",
    "person_id",
    "visit_concept_id",
    "visit_start_date",
    "visit_start_datetime",
    "visit_end_date",
    "visit_end_datetime",
    "visit_type_concept_id",
    "provider_id",
    "care_site_id",
    "visit_source_value",
    "visit_source_concept_id",
    "admitting_source_concept_id",
    "admitting_source_value",
    "discharge_to_concept_id",
    "discharge_to_source_value",
    "preceding_visit_occurrence_id",
]

# The 12 columns of the clean visits table, in output order.
CLEAN_COLUMNS = [
    "visit_occurrence_id",
    "person_id",
    "visit_concept_id",
    "visit_start_datetime",
    "visit_end_datetime",
    "visit_type_concept_id",
    "provider_id",
    "care_site_id",
    "visit_source_value",
    "visit_year",
    "visit_month",
    "visit_duration_days",
]

# Columns of the raw file that the cleaning reads.
REQUIRED_VISIT_COLUMNS = CLEAN_COLUMNS[:9]

# Person columns the analysis reads.
PERSON_COLUMNS = ["person_id", "gender_source_value", "race_source_value"]

# Fill values for missing ids and missing source value.
MISSING_ID = -1
MISSING_SOURCE = "UNKNOWN"

# pandas' default missing-value strings (pandas.read_csv, na_values default),
# including the empty string. The visit reader treats these as missing.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
# --- end of fixed values ------------------------------------------------------

# Accepted text forms of a visit timestamp, blanks around it aside. Each value is
# parsed on its own, so the answer never depends on how rows fall into partitions.
# The usual form, taken as it is:
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"
# All forms, once a date without dashes or with slashes is in dashes and an
# offset has its colon:
TIMESTAMP_FORMS = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"

# The visit numeric id columns parsed from text.
VISIT_ID_COLUMNS = [
    "visit_occurrence_id",
    "person_id",
    "visit_concept_id",
    "visit_type_concept_id",
    "provider_id",
    "care_site_id",
]

RAW_VISIT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in VISIT_COLUMNS])

# The clean table's types; the cleaning is tested against them.
CLEAN_VISIT_SCHEMA = T.StructType(
    [
        T.StructField("visit_occurrence_id", T.LongType()),
        T.StructField("person_id", T.LongType()),
        T.StructField("visit_concept_id", T.LongType()),
        T.StructField("visit_start_datetime", T.TimestampNTZType()),
        T.StructField("visit_end_datetime", T.TimestampNTZType()),
        T.StructField("visit_type_concept_id", T.LongType()),
        T.StructField("provider_id", T.LongType()),
        T.StructField("care_site_id", T.LongType()),
        T.StructField("visit_source_value", T.StringType()),
        T.StructField("visit_year", T.IntegerType()),
        T.StructField("visit_month", T.IntegerType()),
        T.StructField("visit_duration_days", T.DoubleType()),
    ]
)
