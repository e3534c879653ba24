"""Physical-plan checks: the shapes we rely on for scale stay in place."""

import contextlib
import io

import pytest

from tests.conftest import SF001
from vistra.operators import aggregate, clean
from vistra.operators import candidates as C
from vistra.operators.join import visits_person_left
from vistra.plans import queries as Q
from vistra.plans import search
from vistra.sources.parquet import read_parquet, write_parquet


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    skip = {"run_metrics", "shuffle_invariance", "csv_ingest", "csv_ingest_utf16", "csv_ingest_line_breaks", "csv_ingest_utf16_line_breaks",
            "dropped_rows", "malformed_rows", "na_tokens", "input_manifest",
            "detect_encoding", "parquet_round_trip", "cand_history", "cand_sweep"}
    return {name: plan_text(fn(spark, SF001)) for name, fn in Q.QUERIES.items() if name not in skip}


def test_no_cartesian_or_nested_loop_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_no_python_in_the_plans(plans):
    for name, text in plans.items():
        for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert op not in text, (name, op)


def test_rank_filter_is_a_group_limit(plans):
    assert "WindowGroupLimit" in plans["top_months"]


def test_gender_counts_per_person_below_the_join(plans):
    assert "Keys [1]: [person_id" in plans["visits_by_gender"]


class _Jobs:
    """Counts the Spark jobs that start in this thread's group while a plan is built."""

    def __init__(self, spark):
        self.spark = spark

    def of(self, build):
        sc = self.spark.sparkContext
        sc.setJobGroup("building", "no job may run")
        try:
            build()
            return list(sc.statusTracker().getJobIdsForGroup("building"))
        finally:
            sc.setJobGroup("default", "")


@pytest.mark.parametrize("name", ["visits_by_gender", "visits_person_left"])
def test_no_job_runs_while_a_join_is_built(spark, name):
    valid, person = Q.valid_of(spark, SF001), Q.person_of(spark, SF001)
    build = {"visits_by_gender": aggregate.visits_by_gender, "visits_person_left": visits_person_left}[name]
    assert _Jobs(spark).of(lambda: build(valid, person)) == []


def test_search_never_broadcasts_a_population(spark, tmp_dir):
    runs = Q.search_runs(spark, SF001, pop_size=1_000_000)
    assert "BroadcastExchange" not in plan_text(C.tournament(C.score(C.init_population(runs))))
    # a stored population keeps its planner's estimate: the same must hold after a checkpoint
    small = C.score(C.init_population(Q.search_runs(spark, SF001, pop_size=50))).checkpoint(eager=True)
    assert "BroadcastExchange" not in plan_text(C.tournament(small))


def test_a_stored_population_stays_where_it_lies(spark, tmp_dir):
    scored = C.score(C.init_population(Q.search_runs(spark, SF001, pop_size=50)))
    stored = search.store_population(scored.repartition(5, *C.POOL_KEYS), f"{tmp_dir}/p", 5)
    text = plan_text(C.tournament(stored, buckets=5))
    # the draws (keys alone) and the drawn candidates move, the pool doesn't
    exchanges = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert len(exchanges) == 2 and all(", 5), REPARTITION_BY_NUM" in line for line in exchanges)
    assert sorted(C.tournament(stored, buckets=5).collect()) == sorted(C.tournament(scored).collect())
    assert spark.catalog.listTables() == []


def test_a_generation_is_written_by_one_task_a_bucket(spark, tmp_dir):
    scored = C.score(C.init_population(Q.search_runs(spark, SF001, pop_size=50)))
    stored = search.store_population(scored.repartition(5, *C.POOL_KEYS), f"{tmp_dir}/p", 5)
    children = C.score(C.next_generation(stored, 5)).filter("slot > 0")
    again = search.store_population(children, f"{tmp_dir}/q", 5)
    assert len(again.inputFiles()) == 5 and again.count() == children.count()


def test_elite_is_a_hash_aggregate(spark):
    text = plan_text(C.elite(C.score(C.init_population(Q.search_runs(spark, SF001)))))
    assert "SortAggregate" not in text


def test_parquet_scan_prunes_and_pushes(spark, tmp_dir):
    write_parquet(Q.clean_of(spark, SF001), f"{tmp_dir}/v")
    valid = clean.valid_visits(read_parquet(spark, f"{tmp_dir}/v"))
    text = plan_text(aggregate.yearly_visits(valid))
    assert "GreaterThanOrEqual(visit_duration_days,0.0)" in text
    scan = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "visit_source_value" not in scan and "provider_id" not in scan
