"""The oracle SQL itself reproduces FIXTURES.md §4 (DuckDB only, no Spark)."""

import duckdb
import pytest

from vistra.fixtures import TABLES
from vistra.plans.oracle import ORACLE

EXPECTED = {
    # sf: (top_months_ties rows, top_months rows, person rows, clean rows, valid rows with missing ends)
    "0.001": (80, 21, 141, 5874, 4979),
    "0.01": (76, 21, 1411, 58785, 50354),
    "0.1": (35, 22, 14117, 587104, 502812),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_oracle_counts(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf{sf}/{t}.parquet')")
    got = tuple(
        con.execute(f"SELECT count(*) FROM ({ORACLE[q]})").fetchone()[0]
        for q in ["top_months_ties", "top_months", "person_dim", "clean_visits"]
    ) + (con.execute(ORACLE["valid_visit_count"]).fetchone()[0],)
    assert got == EXPECTED[sf]
