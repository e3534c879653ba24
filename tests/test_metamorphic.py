"""Same answer under different shuffle widths and input layouts."""

from tests.conftest import SF001
from vistra.operators import aggregate, clean, quality
from vistra.plans import queries as Q
from vistra.plans import visits as job
from vistra.sources.parquet import read_parquet
from vistra.sources.csv import VisitFile, read_visits_csv, write_csv


def test_shuffle_settings_same_answer(spark):
    runs = job.run_with_shuffle_settings(
        spark, lambda: aggregate.monthly_visits(Q.valid_of(spark, SF001)), [1, 8, 16]
    )
    assert len({r.checksum for r in runs}) == 1
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_one_file_or_many_files(spark, tmp_dir):
    raw = Q.fixtures.visits_raw(spark, SF001)
    write_csv(raw.repartition(1), f"{tmp_dir}/one", header=True)
    write_csv(raw.repartition(6), f"{tmp_dir}/many", header=True)
    a = clean.clean_visits(read_visits_csv(spark, [VisitFile(f"{tmp_dir}/one", True)]))
    b = clean.clean_visits(read_visits_csv(spark, [VisitFile(f"{tmp_dir}/many", True)]))
    assert quality.checksum(a).first() == quality.checksum(b).first()
    assert quality.checksum(a).first() == quality.checksum(Q.clean_of(spark, SF001)).first()


def test_batch_job_end_to_end(spark, tmp_dir):
    files = Q._write_visit_files(Q.fixtures.visits_raw(spark, SF001), f"{tmp_dir}/raw")
    write_csv(Q.fixtures.person_raw(spark, SF001), f"{tmp_dir}/raw/person.csv", header=True)
    job.ingest(spark, files, f"{tmp_dir}/visits")
    res = job.analyse(spark, f"{tmp_dir}/visits", f"{tmp_dir}/raw/person.csv", f"{tmp_dir}/res")
    assert res.valid_visits == 5874
    assert res.yearly[1995] == 936
    assert res.top_months.count() == 21
    parquet_yearly = {r.visit_year: r.visit_count
                      for r in job.yearly_from_parquet(spark, f"{tmp_dir}/visits").collect()}
    assert parquet_yearly == res.yearly  # the two engines' comparison, reconciled
    paths = job.write_charts(spark, f"{tmp_dir}/res")
    assert len(paths) == 3


def test_run_all_strict_reconciliation(spark, tmp_dir):
    import pytest

    from vistra.operators.quality import ReconciliationError

    raw = Q.fixtures.visits_raw(spark, SF001, missing_end=True)
    files = Q._write_visit_files(raw, f"{tmp_dir}/raw")
    write_csv(Q.fixtures.person_raw(spark, SF001), f"{tmp_dir}/raw/person.csv", header=True)
    with pytest.raises(ReconciliationError):
        job.run_all(spark, files, f"{tmp_dir}/raw/person.csv", f"{tmp_dir}/strict", shuffle_settings=(8,))
    rec = job.run_all(spark, files, f"{tmp_dir}/raw/person.csv", f"{tmp_dir}/lenient",
                      shuffle_settings=(8,), strict=False).first()
    assert sum(rec.comparison_results.values()) == 4979
    assert len(rec.visualizations) == 3
    with pytest.raises(FileNotFoundError):
        job.run_all(spark, files, f"{tmp_dir}/raw/nope.csv", f"{tmp_dir}/x", shuffle_settings=(8,))


def test_year_partitioned_ingest_prunes(spark, tmp_dir):
    from tests.test_plans import plan_text
    from pyspark.sql import functions as F

    files = Q._write_visit_files(Q.fixtures.visits_raw(spark, SF001), f"{tmp_dir}/raw")
    job.ingest(spark, files, f"{tmp_dir}/flat")
    job.ingest(spark, files, f"{tmp_dir}/by_year", files_per_year=2)
    flat = read_parquet(spark, f"{tmp_dir}/flat")
    by_year = read_parquet(spark, f"{tmp_dir}/by_year").select(*flat.columns)
    assert quality.checksum(flat).first() == quality.checksum(by_year).first()
    text = plan_text(by_year.filter(F.col("visit_year") == 1996))
    assert "PartitionFilters: [isnotnull(visit_year" in text
    assert by_year.filter(F.col("visit_year") == 1996).count() == 900


def test_shuffle_settings_do_not_move_the_raw_rows(spark, monkeypatch):
    """The raw visits are joined before the settings are tried: what runs under them has no join to move them."""
    from vistra.plans import queries

    seen = []
    monkeypatch.setattr(queries.job, "run_with_shuffle_settings", lambda spark, make, settings: seen.append(make()) or [job.SettingRun(n, 0.0, 1, "1") for n in settings])
    got = queries.q_shuffle_invariance(spark, "/root/testdata/sf0.001")
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" in plan
    assert [r.shuffle_partitions for r in got.collect()] == queries.SHUFFLE_SETTINGS
