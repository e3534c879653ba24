"""Property tests: parsing and labels agree with plain Python on random inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from vistra.functions import parse_long, period_label


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-(2**62), max_value=2**62), min_size=1, max_size=40))
def test_integer_text_parses_exactly(spark, values):
    rows = [(str(v),) for v in values] + [(f" {v} ",) for v in values]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(parse_long("s")).collect()]
    assert got == values + values


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9999), st.integers(1, 12)), min_size=1, max_size=30))
def test_period_label_matches_python(spark, pairs):
    got = [r[0] for r in spark.createDataFrame(pairs, "y int, m int").select(period_label("y", "m")).collect()]
    assert got == [f"{y}-{m:02d}" for y, m in pairs]
