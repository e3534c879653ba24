"""Expected values from FIXTURES.md §4 at sf0.001 (computed independently)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from vistra.operators import aggregate, clean, window
from vistra.plans import queries as Q


@pytest.fixture(scope="module")
def cleaned(spark):
    return Q.clean_of(spark, SF001).cache()


def test_raw_counts(spark):
    raw = Q.fixtures.visits_raw(spark, SF001)
    r = raw.agg(F.count(F.lit(1)), F.count("person_id"),
                F.count_if(F.col("visit_start_datetime") == "not-a-date")).first()
    assert tuple(r) == (6000, 5933, 61)


def test_clean_counts(cleaned):
    r = cleaned.agg(
        F.count(F.lit(1)), F.count_if(F.col("visit_duration_days") == 0),
        F.round(F.avg("visit_duration_days"), 6),
        F.count_if(F.col("provider_id") == -1), F.count_if(F.col("care_site_id") == -1),
        F.count_if(F.col("visit_source_value") == "UNKNOWN"),
    ).first()
    assert tuple(r) == (5874, 2757, 440.957342, 534, 1117, 974)


def test_times_of_day_matter(cleaned):
    """Rows in which whole days, or a duration of the truncated times, would be wrong."""
    start, end = F.col("visit_start_datetime"), F.col("visit_end_datetime")
    truncated = F.timestamp_diff("MICROSECOND", start, end) / 1e6 / 86400
    r = cleaned.agg(
        F.count_if(F.col("visit_duration_days") != F.floor("visit_duration_days")),
        F.count_if((F.col("visit_duration_days") > 0) & (F.abs(F.col("visit_duration_days") - truncated) > 1e-12)),
    ).first()
    assert tuple(r) == (3116, 1734)


def test_monthly_top_and_ties(spark, cleaned):
    monthly = aggregate.monthly_visits(clean.valid_visits(cleaned))
    assert monthly.count() == 80
    assert window.top_months(monthly).count() == 21
    assert Q.q_top_months_ties(spark, SF001).count() == 80


def test_yearly(spark):
    got = {r.visit_year: r.visit_count for r in Q.q_yearly_visits(spark, SF001).collect()}
    assert got == {1995: 936, 1996: 900, 1997: 891, 1998: 938, 1999: 940, 2000: 796, 2001: 473}


def test_yearly_missing_end_variant(spark):
    valid = Q.valid_of(spark, SF001, missing_end=True)
    got = {r.visit_year: r.visit_count for r in aggregate.yearly_visits(valid).collect()}
    assert got == {1995: 798, 1996: 778, 1997: 738, 1998: 808, 1999: 786, 2000: 667, 2001: 404}
    assert sum(got.values()) == 4979
    assert Q.q_reconcile_yearly(spark, SF001).count() == 7


def test_person_and_gender(spark):
    assert Q.fixtures.person_raw(spark, SF001).count() == 150
    assert Q.q_person_dim(spark, SF001).count() == 141
    got = {r.gender_source_value: r.visit_count for r in Q.q_visits_by_gender(spark, SF001).collect()}
    assert got == {"HOUSEHOLD": 796, "MACHINERY": 975, "BUILDING": 1279, "AUTOMOBILE": 900,
                   "FURNITURE": 1518, None: 406}


def test_gender_with_duplicate_person_ids(spark):
    valid, person = Q.valid_of(spark, SF001), Q.person_of(spark, SF001)
    doubled = person.unionByName(person.filter(F.col("person_id") % 3 == 0))
    joined = valid.join(doubled, "person_id", "left").groupBy("gender_source_value").count()
    got = aggregate.visits_by_gender(valid, doubled).collect()
    assert {r[0]: r[1] for r in got} == {r[0]: r[1] for r in joined.collect()}
