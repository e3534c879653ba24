"""Benchmark the headline stages; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_REPEATS (3). Untimed setup writes the fixture's visit CSVs (headed and
headerless) and person CSV under the shared checkpoint folder. Timed, each
repeated and reported as the median with the order of stages alternated:

- ingest        CSV → clean → snappy Parquet (the reference's engine-1 stage)
- analysis      Parquet → valid → monthly (written) → gender join → top months
                → yearly (the reference's full Spark stage)
- charts        the three chart tables from the monthly table
- yearly_count  Parquet → valid → visits per year (the comparison query)
- q_*           registered queries straight from the driver tables, run in full
                into a no-op sink (every column computed, nothing written)
- search_*      evolutionary search, one run per supplier row, population 300,
                BENCH_SEARCH_GENERATIONS (3) generations, once
- xK_*          yearly count and analysis on K stacked copies of the clean
                table (visit and person ids offset per copy, persons copied
                likewise). BENCH_SCALE=auto (default) picks K so the copies
                hold about the reference's 42.4 M visits (K=72 at sf0.1);
                BENCH_SCALE=1 skips it
- xK_ingest     CSV ingest of BENCH_SCALE_INGEST copies (default: 8, some 0.4 GB
                of CSV at sf0.1; 0 skips it), timed once

Each stage's seconds go to stderr as it ends. After BENCH_SECONDS (900) no
further stage begins; those left out are named under "skipped", and the line
holds all that was measured.

The headline ``value`` is the full analysis stage at the reference's row
count (comparable to its "full Spark stage"); without scaling it is
ingest + analysis at the given scale factor.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vistra import fixtures  # noqa: E402
from vistra.operators import candidates as C  # noqa: E402
from vistra.plans import queries as Q  # noqa: E402
from vistra.plans import search  # noqa: E402
from vistra.plans import visits as job  # noqa: E402
from vistra.session import build_session, scratch_path  # noqa: E402
from vistra.sources.csv import write_csv  # noqa: E402
from vistra.sources.parquet import read_parquet  # noqa: E402


REFERENCE_VISITS = 42_404_379  # valid visits in the reference's recorded run


def _sf_value(sf_dir: str):
    name = os.path.basename(sf_dir).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def _stack(df, copies: int, id_cols: list[str], text: bool = False):
    """``copies`` copies of ``df`` with ids offset by 10^9 per copy (explode,
    no join); used only to measure throughput at the reference's size. Text
    that is no number stays as it is."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__copy")
    out = df.select("*", copy)
    for c in id_cols:
        ids = F.trim(c).try_cast("bigint") if text else F.col(c)
        shifted = ids + F.col("__copy").cast("bigint") * F.lit(10**9)
        out = out.withColumn(c, F.coalesce(shifted.cast("string"), F.col(c)) if text else shifted)
    return out.drop("__copy")


def main() -> None:
    deadline = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "900"))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG")  # an existing folder: write Spark's event log there
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(
        f"local[{cpus}]",
        app_name="vistra-bench",
        shuffle_partitions=2 * cpus,
        extra_conf=extra,
    )

    root = scratch_path(spark, "bench")
    files = Q._write_visit_files(fixtures.visits_raw(spark, sf_dir), f"{root}/raw")
    person_path = f"{root}/raw/{Q.PERSON_FILE_NAME}"
    write_csv(fixtures.person_raw(spark, sf_dir), person_path, header=True)
    visits_dir = f"{root}/visits"
    job.ingest(spark, files, visits_dir)  # warm-up, also produces the table
    n_visits = read_parquet(spark, visits_dir).count()

    def ingest():
        job.ingest(spark, files, f"{root}/visits-bench")

    def analysis():
        job.analyse(spark, visits_dir, person_path, f"{root}/results")

    def chart_stage():
        job.write_charts(spark, f"{root}/results")

    def yearly_count():
        job.yearly_from_parquet(spark, visits_dir).collect()

    def registered(name):
        fn = Q.QUERIES[name]
        # run the whole plan (every column), write nothing
        return lambda: fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    stages = {
        "ingest": ingest,
        "analysis": analysis,
        "charts": chart_stage,
        "yearly_count": yearly_count,
        "q_clean_visits": registered("clean_visits"),
        "q_monthly_visits": registered("monthly_visits"),
        "q_visits_by_gender": registered("visits_by_gender"),
        "q_top_months": registered("top_months"),
        "q_visits_person_left": registered("visits_person_left"),
    }
    times: dict[str, list[float]] = {}
    skipped: list[str] = []

    def timed(name, run, rounds=1):
        """Run a stage some times while there is time left, and tell its seconds."""
        for _ in range(rounds):
            if time.perf_counter() > deadline:
                if name not in times and name not in skipped:
                    skipped.append(name)
                return None
            t0 = time.perf_counter()
            out = run()
            times.setdefault(name, []).append(time.perf_counter() - t0)
            print(f"{name} {times[name][-1]:.3f}", file=sys.stderr, flush=True)
        return out

    order = list(stages)
    for i in range(repeats):
        for name in order if i % 2 == 0 else list(reversed(order)):
            timed(name, stages[name])

    # Stack copies up to the reference's recorded run (42,404,379 valid visits).
    scale_env = os.environ.get("BENCH_SCALE", "auto")
    scale = max(1, round(REFERENCE_VISITS / n_visits)) if scale_env == "auto" else int(scale_env)
    scaled_rows = None
    if scale > 1 and time.perf_counter() < deadline:
        scaled_dir = f"{root}/visits-x{scale}"
        stacked = _stack(read_parquet(spark, visits_dir), scale, ["visit_occurrence_id", "person_id"])
        stacked.write.mode("overwrite").parquet(scaled_dir)
        scaled_person = f"{root}/raw/person-x{scale}.csv"
        write_csv(_stack(fixtures.person_raw(spark, sf_dir), scale, ["person_id"], text=True), scaled_person, header=True)
        scaled_rows = spark.read.parquet(scaled_dir).count()
        for _ in range(3):
            timed(f"x{scale}_yearly_count", lambda: job.yearly_from_parquet(spark, scaled_dir).collect())
            timed(f"x{scale}_analysis", lambda: job.analyse(spark, scaled_dir, scaled_person, f"{root}/results-x{scale}"))

    # Search: one run per supplier row, population 300 (the reference's size).
    search_gens = int(os.environ.get("BENCH_SEARCH_GENERATIONS", "3"))
    n_runs = 0
    if search_gens > 0:
        runs = C.runs_table(fixtures.load_table(spark, sf_dir, "supplier"), "s_suppkey", 300)
        n_runs = runs.count()
        timed(f"search_{search_gens}_generations", lambda: search.evolve(runs, search_gens).best.collect())

    ingest_scale = int(os.environ.get("BENCH_SCALE_INGEST", "8"))
    if ingest_scale and scale > 1 and time.perf_counter() < deadline:
        raw = _stack(fixtures.visits_raw(spark, sf_dir), ingest_scale, ["visit_occurrence_id", "person_id"], text=True)
        big_files = Q._write_visit_files(raw, f"{root}/raw-x{ingest_scale}")
        timed(f"x{ingest_scale}_ingest", lambda: job.ingest(spark, big_files, f"{root}/visits-x{ingest_scale}-ingested"))
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    found = f"search_{search_gens}_generations"
    search_rate = round(n_runs * 300 * (search_gens + 1) / med[found]) if found in med else None
    if f"x{scale}_analysis" in med:
        name = "full_analysis_seconds_at_reference_rows" if scale_env == "auto" else f"full_analysis_seconds_x{scale}"
        metric, headline = name, med[f"x{scale}_analysis"]
    else:
        metric, headline = "ingest_plus_analysis_seconds", med.get("ingest", 0) + med.get("analysis", 0)
    print(
        json.dumps(
            {
                "metric": metric,
                "value": round(headline, 3),
                "unit": "sec",
                "queries": med,
                "sf": _sf_value(sf_dir),
                "visits": n_visits,
                "yearly_visits_per_sec": round(n_visits / med["yearly_count"]) if med.get("yearly_count") else None,
                "ingest_visits_per_sec": round(n_visits / med["ingest"]) if med.get("ingest") else None,
                "scaled_visits": scaled_rows,
                "scaled_yearly_visits_per_sec": round(scaled_rows / med[f"x{scale}_yearly_count"])
                if f"x{scale}_yearly_count" in med else None,
                "skipped": skipped,
                "search_candidates_per_sec": search_rate,
                "repeats": repeats,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
