"""Generation loop and configuration sweep over candidate tables.

The driver holds only the loop counter. Each generation's scored population
is written as a Parquet table bucketed by (run, generation, slot) under
``spark.checkpoint.dir`` (reliable storage) and read back: that cuts the plan,
which would grow threefold per generation (elite, children, tournament pool),
spares a replay after a lost executor, and keeps the layout, so that the
tournament exchanges draws and drawn candidates but never the pool. Two
folders take turns, so older populations don't pile up. Each generation's best
fitness per run is written at once to a table under the same folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistra.operators import candidates as C
from vistra.session import ensure_checkpoint_dir, scratch_path


# --- fixed values: the reference's search size -------------------------------
REFERENCE_POPULATION = 300
REFERENCE_GENERATIONS = 50
# --- end of fixed values -------------------------------------------------------

# A bucket holds about so many candidates (some 100 bytes each, unpacked);
# small searches still get a bucket per core.
BUCKET_ROWS = 500_000


@dataclass
class SearchResult:
    history: DataFrame  # (run_id, config_id, generation, best_fitness)
    best: DataFrame  # per run: params, best_x, best_y, best_fitness
    final: DataFrame  # last scored population


def bucket_count(runs: DataFrame) -> int:
    """Buckets for the populations of ``runs``, by their candidates in all."""
    rows = runs.agg(F.sum(F.col("pop_size").cast("bigint"))).first()[0] or 0
    return max(runs.sparkSession.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS))


def store_population(scored: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write a population bucketed by its keys and read it back.

    Buckets are a property of catalog tables: the table gets a name of its own
    for the write and leaves the catalog once it has been resolved. Its files
    stay at ``path``.
    """
    spark = scored.sparkSession
    name = f"population_{uuid.uuid4().hex}"
    scored.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *C.POOL_KEYS).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def evolve(
    runs: DataFrame,
    generations: int,
    checkpoint_every: int = 1,
    history_dir: str | None = None,
) -> SearchResult:
    """Run ``generations`` breeding steps for every run, then score once more.

    ``checkpoint_every``: the population is stored at each so-manyth generation (0:
    only the last one is). ``history_dir`` (default: a fresh folder under the
    checkpoint folder) receives one sub-table per generation, written with
    overwrite, so a retried write never duplicates rows.
    """
    spark = runs.sparkSession
    ensure_checkpoint_dir(spark)
    hist = history_dir or scratch_path(spark, "search-history")
    folder = scratch_path(spark, "search-population")
    buckets = bucket_count(runs)
    population = C.init_population(runs).repartition(buckets, *C.POOL_KEYS)
    writes = 0
    for g in range(generations):
        scored = C.score(population)
        if checkpoint_every and g % checkpoint_every == 0:
            scored = store_population(scored, f"{folder}/{writes % 2}", buckets)
            writes += 1
        C.best_per_generation(scored).write.mode("overwrite").parquet(f"{hist}/g{g:06d}")
        population = C.next_generation(scored, buckets)
    final = store_population(C.score(population), f"{folder}/{writes % 2}", buckets)
    C.best_per_generation(final).write.mode("overwrite").parquet(f"{hist}/g{generations:06d}")
    history = spark.read.option("recursiveFileLookup", "true").parquet(hist)
    return SearchResult(history=history, best=C.best_candidate(final), final=final)


def sweep_summary(best: DataFrame) -> DataFrame:
    """Per configuration: number of runs, best fitness, mean of the runs' best."""
    return best.groupBy("config_id", "pop_size", "mutation_rate", "sigma").agg(
        F.count(F.lit(1)).alias("runs"),
        F.max("best_fitness").alias("best_fitness"),
        F.avg("best_fitness").alias("mean_best_fitness"),
    )
