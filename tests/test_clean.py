"""Cleaning rules on small literal inputs."""

import datetime as dt

from vistra.operators import clean
from vistra.schema import RAW_VISIT_SCHEMA, VISIT_COLUMNS


def raw_rows(spark, rows):
    full = []
    for r in rows:
        d = dict.fromkeys(VISIT_COLUMNS)
        d.update(r)
        full.append(tuple(d[c] for c in VISIT_COLUMNS))
    return spark.createDataFrame(full, RAW_VISIT_SCHEMA)


def test_clean_rules(spark):
    raw = raw_rows(spark, [
        {"visit_occurrence_id": "1", "person_id": "10", "visit_start_datetime": "2010-03-01 00:00:00",
         "visit_end_datetime": "2010-03-02 00:00:00"},
        {"visit_occurrence_id": "2", "person_id": None, "visit_start_datetime": "2010-03-01 00:00:00"},
        {"visit_occurrence_id": "3", "person_id": "11", "visit_start_datetime": "bad"},
        {"visit_occurrence_id": None, "person_id": "12", "visit_start_datetime": "2010-03-01 00:00:00"},
        {"visit_occurrence_id": "5", "person_id": "13", "visit_start_datetime": "2011-05-01 00:00:00",
         "visit_end_datetime": "2011-04-30 00:00:00", "provider_id": "7", "visit_source_value": "OP"},
    ])
    out = {r.visit_occurrence_id: r for r in clean.clean_visits(raw).collect()}
    assert sorted(out) == [1, 5]
    a, b = out[1], out[5]
    assert (a.provider_id, a.care_site_id, a.visit_source_value) == (-1, -1, "UNKNOWN")
    assert (a.visit_year, a.visit_month, a.visit_duration_days) == (2010, 3, 1.0)
    assert (b.provider_id, b.visit_source_value, b.visit_duration_days) == (7, "OP", 0.0)
    assert a.visit_start_datetime == dt.datetime(2010, 3, 1)


def test_valid_removes_only_missing_end(spark):
    raw = raw_rows(spark, [
        {"visit_occurrence_id": "1", "person_id": "1", "visit_start_datetime": "2010-01-01 00:00:00",
         "visit_end_datetime": None},
        {"visit_occurrence_id": "2", "person_id": "1", "visit_start_datetime": "2010-01-02 00:00:00",
         "visit_end_datetime": "2010-01-01 00:00:00"},
    ])
    assert [r.visit_occurrence_id for r in clean.valid_visits(clean.clean_visits(raw)).collect()] == [2]


def test_na_tokens_visits_become_missing(spark):
    raw = raw_rows(spark, [
        {"visit_occurrence_id": "1", "person_id": "1", "visit_start_datetime": "2010-01-01 00:00:00",
         "visit_source_value": t, "provider_id": t}
        for t in ["NA", "", "null", "N/A", "nan"]
    ])
    cleaned = clean.clean_visits(clean.normalize_na_tokens(raw))
    got = cleaned.select("visit_source_value", "provider_id").distinct().collect()
    assert [(r[0], r[1]) for r in got] == [("UNKNOWN", -1)]


def test_person_tokens_stay_text(spark):
    raw = spark.createDataFrame(
        [(" 5 ", "NA", "null"), ("NA", "F", "x"), ("6", "null", "NA")],
        "person_id string, gender_source_value string, race_source_value string",
    )
    rows = sorted(clean.person_dim(raw).collect())
    assert [(r.person_id, r.gender_source_value) for r in rows] == [(5, "NA"), (6, "null")]


def test_fill_report(spark):
    raw = raw_rows(spark, [
        {"visit_occurrence_id": "1", "person_id": "1", "visit_start_datetime": "2010-01-01 00:00:00"},
        {"visit_occurrence_id": "2", "person_id": "1", "visit_start_datetime": "2010-01-01 00:00:00",
         "provider_id": "3", "care_site_id": "4", "visit_source_value": "IP"},
    ])
    rep = {r.column_name: r.filled_rows for r in clean.fill_report(clean.clean_visits(raw)).collect()}
    assert rep == {"provider_id": 1, "care_site_id": 1, "visit_source_value": 1}
