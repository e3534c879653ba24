"""DuckDB SQL for the candidate-table queries (same draws, same order of
floating-point operations as the Spark expressions)."""

from __future__ import annotations

import math

PARAMS = "config_id, seed, pop_size, mutation_rate, sigma"
TWO_PI = repr(2.0 * math.pi)
LO, HI = -5.0, 5.0


def _u(tag_sql: str, slot: str = "slot", chunk: str = "0") -> str:
    key = (
        "concat_ws('|', seed::VARCHAR, run_id::VARCHAR, generation::VARCHAR, "
        f"{slot}::VARCHAR, {tag_sql})"
    )
    return f"(('0x' || substr(md5({key}), 1 + 8 * ({chunk}), 8))::BIGINT / 4294967296.0)"


def _d(v: float) -> str:
    return f"({v!r}::DOUBLE)"


def runs_sql(pop_size: int, seed: int = 42, rate: float = 0.15, sigma: float = 0.3) -> str:
    return (
        f"runs AS (SELECT s_suppkey::BIGINT AS run_id, 0 AS config_id, {seed}::BIGINT AS seed, "
        f"{pop_size} AS pop_size, {_d(rate)} AS mutation_rate, {_d(sigma)} AS sigma FROM supplier)"
    )


def sweep_runs_sql(configs: list[dict]) -> str:
    n = len(configs)
    parts = [
        f"SELECT (s_suppkey * {n} + {i})::BIGINT AS run_id, {int(c['config_id'])} AS config_id, "
        f"{int(c.get('seed', 42))}::BIGINT AS seed, {int(c['pop_size'])} AS pop_size, "
        f"{_d(float(c.get('mutation_rate', 0.15)))} AS mutation_rate, {_d(float(c.get('sigma', 0.3)))} AS sigma "
        "FROM supplier"
        for i, c in enumerate(configs)
    ]
    return "runs AS (" + " UNION ALL ".join(parts) + ")"


def _between(lo: str, hi: str, u: str) -> str:
    return f"({lo} + ({hi} - {lo}) * {u})"


INIT = f"""pop0 AS (
  SELECT run_id, generation, slot,
         {_between(_d(LO), _d(HI), _u("'init'", chunk="0"))} AS x,
         {_between(_d(LO), _d(HI), _u("'init'", chunk="1"))} AS y, {PARAMS}
  FROM (SELECT run_id, 0 AS generation, unnest(range(pop_size))::INTEGER AS slot, {PARAMS} FROM runs))"""


def _fitness(x: str = "x", y: str = "y") -> str:
    return (
        f"((20.0::DOUBLE - ({x} * {x} + {y} * {y})) + 10.0::DOUBLE * "
        f"(cos({TWO_PI}::DOUBLE * {x}) + cos({TWO_PI}::DOUBLE * {y})))"
    )


def step_sql(g: int) -> str:
    """CTEs scored{g}, parents{g}, cross{g}, mut{g}, pop{g+1}."""
    # one row per (parent, draw): two lists unnested side by side, no join
    picks = "unnest([1, 1, 1, 2, 2, 2]) AS parent, unnest([0, 1, 2, 0, 1, 2]) AS draw"
    tour_tag = "'tour_' || parent::VARCHAR"

    def blx(gene: str) -> str:
        a, b = f"p1_{gene}", f"p2_{gene}"
        spread = f"(0.5::DOUBLE * abs({a} - {b}))"
        lo = f"(least({a}, {b}) - {spread})"
        hi = f"(greatest({a}, {b}) + {spread})"
        return _between(lo, hi, _u("'blx'", "child_slot", "0" if gene == "x" else "1"))

    def mut(gene: str) -> str:
        noise = (
            f"(sigma * (sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_u(f"'mut_{gene}'", 'child_slot', '1')})) "
            f"* cos({TWO_PI}::DOUBLE * {_u(f"'mut_{gene}'", 'child_slot', '2')})))"
        )
        moved = f"(CASE WHEN {_u(f"'mut_{gene}'", 'child_slot', '0')} < mutation_rate THEN {gene} + {noise} ELSE {gene} END)"
        return f"least(greatest({moved}, {_d(LO)}), {_d(HI)})"

    return f"""scored{g} AS (SELECT *, {_fitness()} AS fitness FROM pop{g}),
drawn{g} AS (
  SELECT run_id, generation, child_slot, {PARAMS}, parent, draw,
         floor({_u(tour_tag, 'child_slot', 'draw')} * pop_size)::INTEGER AS slot
  FROM (SELECT run_id, generation, slot AS child_slot, {PARAMS}, {picks} FROM scored{g} WHERE slot >= 1)),
ranked{g} AS (
  SELECT d.*, s.x, s.y, s.fitness,
         row_number() OVER (PARTITION BY d.run_id, d.generation, d.child_slot, d.parent
                            ORDER BY s.fitness DESC, d.draw ASC) AS rn
  FROM drawn{g} d JOIN scored{g} s ON d.run_id = s.run_id AND d.generation = s.generation AND d.slot = s.slot),
parents{g} AS (
  SELECT run_id, generation, child_slot, {PARAMS},
         max(x) FILTER (WHERE parent = 1 AND rn = 1) AS p1_x, max(y) FILTER (WHERE parent = 1 AND rn = 1) AS p1_y,
         max(x) FILTER (WHERE parent = 2 AND rn = 1) AS p2_x, max(y) FILTER (WHERE parent = 2 AND rn = 1) AS p2_y
  FROM ranked{g} GROUP BY run_id, generation, child_slot, {PARAMS}),
cross{g} AS (SELECT run_id, generation, child_slot, {blx('x')} AS x, {blx('y')} AS y, {PARAMS} FROM parents{g}),
mut{g} AS (SELECT run_id, generation, child_slot, {mut('x')} AS x, {mut('y')} AS y, {PARAMS} FROM cross{g}),
elite{g} AS (
  SELECT run_id, generation, x, y, {PARAMS} FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY fitness DESC, slot ASC) AS rn FROM scored{g})
  WHERE rn = 1),
pop{g + 1} AS (
  SELECT run_id, generation + 1 AS generation, 0 AS slot, x, y, {PARAMS} FROM elite{g}
  UNION ALL
  SELECT run_id, generation + 1 AS generation, child_slot AS slot, x, y, {PARAMS} FROM mut{g})"""


def chain(runs: str, generations: int, final_scored: bool = True) -> str:
    ctes = [runs, INIT] + [step_sql(g) for g in range(generations)]
    if final_scored:
        ctes.append(f"scored{generations} AS (SELECT *, {_fitness()} AS fitness FROM pop{generations})")
    return "WITH " + ",\n".join(ctes) + "\n"


def r6(c: str) -> str:
    return f"round({c}, 6) AS {c}"


def search_oracle(pop_size: int, generations: int, sweep_configs: list[dict]) -> dict[str, str]:
    runs = runs_sql(pop_size)
    one = chain(runs, 1, final_scored=False)
    hist_parts = " UNION ALL ".join(
        f"SELECT run_id, config_id, generation, max(fitness) AS best_fitness FROM scored{g} "
        "GROUP BY run_id, config_id, generation"
        for g in range(generations + 1)
    )
    sweep = chain(sweep_runs_sql(sweep_configs), generations)
    return {
        "cand_init": one + f"SELECT run_id, generation, slot, {r6('x')}, {r6('y')} FROM pop0",
        "cand_score": one + f"SELECT run_id, generation, slot, {r6('x')}, {r6('y')}, {r6('fitness')} FROM scored0",
        "cand_tournament": one
        + f"SELECT run_id, generation, child_slot, {r6('p1_x')}, {r6('p1_y')}, {r6('p2_x')}, {r6('p2_y')} FROM parents0",
        "cand_crossover": one + f"SELECT run_id, generation, child_slot, {r6('x')}, {r6('y')} FROM cross0",
        "cand_mutate": one + f"SELECT run_id, generation, child_slot, {r6('x')}, {r6('y')} FROM mut0",
        "cand_next_generation": one + f"SELECT run_id, generation, slot, {r6('x')}, {r6('y')} FROM pop1",
        "cand_history": chain(runs, generations)
        + f"SELECT run_id, config_id, generation, round(best_fitness, 6) AS best_fitness FROM ({hist_parts})",
        "cand_best": chain(runs, generations)
        + f"""SELECT run_id, config_id, round(x, 6) AS best_x, round(y, 6) AS best_y, round(fitness, 6) AS best_fitness
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY fitness DESC, slot ASC) AS rn
      FROM scored{generations}) WHERE rn = 1""",
        "cand_sweep": sweep
        + f"""SELECT config_id, pop_size, mutation_rate, sigma, count(*) AS runs,
       round(max(best_fitness), 6) AS best_fitness, round(avg(best_fitness), 6) AS mean_best_fitness
FROM (SELECT run_id, config_id, pop_size, mutation_rate, sigma, max(fitness) AS best_fitness
      FROM scored{generations} GROUP BY run_id, config_id, pop_size, mutation_rate, sigma)
GROUP BY config_id, pop_size, mutation_rate, sigma""",
    }
