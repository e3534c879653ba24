"""Evolutionary search as operators over candidate tables.

A population is a DataFrame with one row per candidate:
``(run_id, generation, slot, x, y)`` plus the run's parameters carried as
columns (``seed, pop_size, mutation_rate, sigma, config_id``), so many
independent searches — seeds × settings — evolve together in one plan and
each run may have its own settings. Every step is a column expression, an
equi-join or a grouped aggregate keyed by run; nothing is collected.

Ties follow "first maximum wins": the lowest slot for the elite, the
earliest draw in a tournament.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistra.functions.draws import (
    draw_hash,
    objective,
    standard_normal,
    uniform,
    uniform_between,
    uniform_from_hash,
)
from vistra.functions.numbers import clip_between

# --- fixed values: the search's settings, as in the reference ---------------
BOUNDS = (-5.0, 5.0)
TOURNAMENT_K = 3
BLX_ALPHA = 0.5
DEFAULT_MUTATION_RATE = 0.15
DEFAULT_SIGMA = 0.3
# --- end of fixed values -------------------------------------------------------

# One candidate each; a stored population is bucketed by them.
POOL_KEYS = ["run_id", "generation", "slot"]
PARAM_COLUMNS = ["config_id", "seed", "pop_size", "mutation_rate", "sigma"]


def runs_table(
    keys: DataFrame,
    key_column: str,
    pop_size: int,
    seed: int = 42,
    mutation_rate: float = DEFAULT_MUTATION_RATE,
    sigma: float = DEFAULT_SIGMA,
    config_id: int = 0,
) -> DataFrame:
    """One search per row of ``keys`` (its ``key_column`` becomes ``run_id``)."""
    return keys.select(
        F.col(key_column).cast("bigint").alias("run_id"),
        F.lit(config_id).cast("int").alias("config_id"),
        F.lit(seed).cast("bigint").alias("seed"),
        F.lit(pop_size).cast("int").alias("pop_size"),
        F.lit(float(mutation_rate)).alias("mutation_rate"),
        F.lit(float(sigma)).alias("sigma"),
    )


def runs_for_configs(keys: DataFrame, key_column: str, configs: list[dict]) -> DataFrame:
    """Every key × every config, without a join: each key row is exploded
    into one row per config (configs are a short literal list). ``run_id`` is
    ``key * len(configs) + config index`` so draws differ between configs."""
    n = len(configs)
    entries = F.array(
        *[
            F.struct(
                F.lit(i).cast("int").alias("idx"),
                F.lit(int(c["config_id"])).cast("int").alias("config_id"),
                F.lit(int(c.get("seed", 42))).cast("bigint").alias("seed"),
                F.lit(int(c["pop_size"])).cast("int").alias("pop_size"),
                F.lit(float(c.get("mutation_rate", DEFAULT_MUTATION_RATE))).alias("mutation_rate"),
                F.lit(float(c.get("sigma", DEFAULT_SIGMA))).alias("sigma"),
            )
            for i, c in enumerate(configs)
        ]
    )
    exploded = keys.select(F.col(key_column).cast("bigint").alias("__key"), F.explode(entries).alias("c"))
    return exploded.select(
        (F.col("__key") * F.lit(n) + F.col("c.idx")).cast("bigint").alias("run_id"),
        *[F.col(f"c.{p}").alias(p) for p in PARAM_COLUMNS],
    )


def _draw(tag: str, chunk: int, slot_col: str = "slot") -> F.Column:
    return uniform(F.col("seed"), F.col("run_id"), F.col("generation"), F.col(slot_col), tag, chunk)


# Slots are generated in blocks: one row per block is shuffled round-robin
# over the cluster's cores, then each block expands to its slots, so a run
# with a huge population is generated by many tasks instead of one. The
# partition count is explicit because the block rows are few bytes: a
# size-based (AQE) choice would put them all in one task, and all later
# per-candidate work (hash draws, tournaments) would follow that layout.
SLOT_BLOCK = 4096


def init_population(runs: DataFrame, bounds: tuple[float, float] = BOUNDS) -> DataFrame:
    """Generation 0: ``pop_size`` candidates per run, uniform in bounds."""
    lo, hi = bounds
    blocks = runs.select(
        *runs.columns,
        F.explode(
            F.sequence(F.lit(0), F.floor((F.col("pop_size") - 1) / SLOT_BLOCK).cast("int"))
        ).alias("__block"),
    ).repartition(runs.sparkSession.sparkContext.defaultParallelism)
    start = F.col("__block") * SLOT_BLOCK
    end = F.least(start + SLOT_BLOCK, F.col("pop_size")) - 1
    slots = blocks.select(
        *runs.columns,
        F.lit(0).alias("generation"),
        F.explode(F.sequence(start, end)).alias("slot"),
    )
    return slots.select(
        "run_id", "generation", "slot",
        uniform_between(lo, hi, _draw("init", 0)).alias("x"),
        uniform_between(lo, hi, _draw("init", 1)).alias("y"),
        *PARAM_COLUMNS,
    )


def score(population: DataFrame) -> DataFrame:
    """Add ``fitness`` (the objective, one codegen expression per row)."""
    return population.withColumn("fitness", objective("x", "y"))


def tournament(scored: DataFrame, k: int = TOURNAMENT_K, buckets: int | None = None) -> DataFrame:
    """Two parents per child slot 1..pop_size-1, each the fittest of ``k``
    slots drawn with replacement (earliest draw wins a tie).

    Each child row gets its 2·k drawn slots (one md5 per parent and four
    draws), is exploded to one row per draw, equi-joined to the population on (run, generation, slot), and
    folded back to one row per child by a hash aggregate whose buffers are
    the drawn candidates' values; the winner is then picked by a column
    expression. Output: ``(run_id, generation, child_slot, p1_x, p1_y, p2_x,
    p2_y)`` plus the run parameters.

    ``buckets``: the population is stored in so many buckets by POOL_KEYS.
    Then it stays where it lies: only the draws (keys alone) go to it and the
    drawn candidates go to their child, to where the next generation's bucket
    of that child is written.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    key = [F.col("seed"), F.col("run_id"), F.col("generation"), F.col("child_slot")]
    children = scored.filter(F.col("slot") >= 1).select(
        "run_id", "generation", F.col("slot").alias("child_slot"), "seed", "pop_size"
    ).select(
        "*", *[draw_hash(*key, f"tour_{p}" + (f"_{c}" if c else "")).alias(f"__h{p}_{c}") for p in (1, 2) for c in range(-(-k // 4))]
    )
    picks = F.array(
        *[
            F.struct(
                F.lit(p).alias("parent"),
                F.lit(j).alias("draw"),
                F.floor(uniform_from_hash(F.col(f"__h{p}_{j // 4}"), j % 4) * F.col("pop_size")).cast("int").alias("slot"),
            )
            for p in (1, 2)
            for j in range(k)
        ]
    )
    draws = children.select("run_id", "generation", "child_slot", F.inline(picks))
    if buckets:
        draws = draws.repartition(buckets, *POOL_KEYS)
    # never broadcast: the planner's size estimate does not see that a run's
    # row became a whole population, so it would take any pool for a small one
    pool = scored.select(*POOL_KEYS, "x", "y", "fitness", *PARAM_COLUMNS).hint("merge")
    joined = draws.join(pool, POOL_KEYS).withColumn("__next", F.col("generation") + 1)
    if buckets:
        joined = joined.repartition(buckets, "run_id", "__next", "child_slot")

    def value(p: int, j: int, c: str) -> F.Column:
        hit = (F.col("parent") == p) & (F.col("draw") == j)
        return F.max(F.when(hit, F.col(c))).alias(f"{c}_{p}_{j}")

    folded = joined.groupBy("run_id", "__next", "child_slot").agg(
        *[F.max(c).alias(c) for c in PARAM_COLUMNS],  # constant within a run
        *[value(p, j, c) for p in (1, 2) for j in range(k) for c in ("x", "y", "fitness")],
    )

    def winner(p: int, gene: str) -> F.Column:
        # first maximum wins: draw j is chosen if it beats every earlier draw
        # strictly and is at least as fit as every later one
        expr = F.col(f"{gene}_{p}_{k - 1}")
        for j in reversed(range(k - 1)):
            f_j = F.col(f"fitness_{p}_{j}")
            best = F.lit(True)
            for i in range(j + 1, k):
                best = best & (f_j >= F.col(f"fitness_{p}_{i}"))
            expr = F.when(best, F.col(f"{gene}_{p}_{j}")).otherwise(expr)
        return expr.alias(f"p{p}_{gene}")

    return folded.select(
        "run_id", (F.col("__next") - 1).alias("generation"), "child_slot",
        winner(1, "x"), winner(1, "y"), winner(2, "x"), winner(2, "y"),
        *PARAM_COLUMNS,
    )


def crossover(parents: DataFrame, alpha: float = BLX_ALPHA) -> DataFrame:
    """Blend crossover per gene: uniform in [min − α·|Δ|, max + α·|Δ|]."""

    def gene(g: str) -> F.Column:
        a, b = F.col(f"p1_{g}"), F.col(f"p2_{g}")
        spread = F.lit(float(alpha)) * F.abs(a - b)
        lo = F.least(a, b) - spread
        hi = F.greatest(a, b) + spread
        return uniform_between(lo, hi, _draw("blx", 0 if g == "x" else 1, "child_slot")).alias(g)

    return parents.select("run_id", "generation", "child_slot", gene("x"), gene("y"), *PARAM_COLUMNS)


def mutate(children: DataFrame, bounds: tuple[float, float] = BOUNDS) -> DataFrame:
    """Gaussian mutation: each gene with probability ``mutation_rate`` gets
    ``sigma``·N(0, 1) added; then every gene is clipped to the bounds."""
    lo, hi = bounds

    def gene(g: str) -> F.Column:
        hit = _draw(f"mut_{g}", 0, "child_slot") < F.col("mutation_rate")
        noise = F.col("sigma") * standard_normal(
            _draw(f"mut_{g}", 1, "child_slot"), _draw(f"mut_{g}", 2, "child_slot")
        )
        moved = F.when(hit, F.col(g) + noise).otherwise(F.col(g))
        return clip_between(moved, lo, hi).alias(g)

    return children.select("run_id", "generation", "child_slot", gene("x"), gene("y"), *PARAM_COLUMNS)


def _fittest(scored: DataFrame) -> DataFrame:
    """The fittest candidate of each run and generation (lowest slot among equals), with its fitness.

    First the best fitness, then the lowest slot among the rows that have it:
    both are hash aggregates over plain numbers, so the population is not
    sorted. The best-fitness side is one row per run; Spark joins it by its size.
    """
    top = scored.groupBy("run_id", "generation").agg(F.max("fitness").alias("fitness"))
    tied = scored.join(top, ["run_id", "generation", "fitness"])
    return tied.groupBy("run_id", "generation").agg(
        F.min_by("x", "slot").alias("x"), F.min_by("y", "slot").alias("y"), F.max("fitness").alias("fitness"),
        *[F.max(c).alias(c) for c in PARAM_COLUMNS],  # constant within a run
    )


def elite(scored: DataFrame) -> DataFrame:
    """Best candidate per run (lowest slot among equal fitness), one row per run."""
    return _fittest(scored).select("run_id", "generation", "x", "y", *PARAM_COLUMNS)


def next_generation(scored: DataFrame, buckets: int | None = None) -> DataFrame:
    """Elite in slot 0, bred children in slots 1..pop_size-1, generation + 1
    (``buckets``: see ``tournament``)."""
    kept = elite(scored).select(
        "run_id", (F.col("generation") + 1).alias("generation"), F.lit(0).alias("slot"),
        "x", "y", *PARAM_COLUMNS,
    )
    bred = mutate(crossover(tournament(scored, buckets=buckets))).select(
        "run_id", (F.col("generation") + 1).alias("generation"), F.col("child_slot").alias("slot"),
        "x", "y", *PARAM_COLUMNS,
    )
    return kept.unionByName(bred)


def best_per_generation(scored: DataFrame) -> DataFrame:
    """History rows: (run_id, config_id, generation, best_fitness)."""
    return scored.groupBy("run_id", "config_id", "generation").agg(
        F.max("fitness").alias("best_fitness")
    )


def best_candidate(scored: DataFrame) -> DataFrame:
    """Per run: the fittest candidate (lowest slot on ties) and its fitness."""
    return _fittest(scored).select(
        "run_id", *PARAM_COLUMNS,
        F.col("x").alias("best_x"), F.col("y").alias("best_y"), F.col("fitness").alias("best_fitness"),
    )
