"""Records with line breaks and split UTF-16 files, against whole reads; blocks of a few bytes."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from vistra.operators import clean
from vistra.sources import records as R
from vistra.sources.csv import VisitFile, read_visits_csv

NEEDED = "visit_occurrence_id,person_id,visit_concept_id,visit_start_datetime,visit_end_datetime,visit_type_concept_id,provider_id,care_site_id,visit_source_value"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("", False, True), ("a,b", False, True), ('a,"b', True, False), ('"', True, False), ('""', False, True), ('a"b,c', False, False),
        ('"a""', True, False), ('x,"a""",', False, False), ('"a"b"c', False, False), ('a,"b","', True, True), (',"', True, False), ('"a,b",c', False, False),
    ],
)
def test_states_of_lines(line, outside, inside):
    assert R.ends_open(line, False) is outside
    assert R.ends_open(line, True) is inside


def test_a_very_long_line_is_no_recursion():
    assert R.ends_open('a,"' + 'x""' * 300_000, False)
    assert not R.ends_open('"a",' * 300_000 + "z", False)


def random_rows(rng, n):
    bits = ["a", "\n", "\r\n", '"', ",", "é", "ਊ", "ଊ", "਀", "\u000b", "\\", " ", "\U0001f600", "bc"]
    return [[str(i), "".join(rng.choice(bits) for _ in range(rng.randrange(8))), rng.choice(["p", "", "q r"])] for i in range(n)]


def as_csv(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def parsed(records):
    text = "\n".join(records)
    return sorted(csv.reader(io.StringIO(text, newline="")))


@pytest.mark.parametrize("block", [7, 50, 400])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_utf8_blocks(spark, tmp_dir, block, end):
    rng = random.Random(block)
    rows = random_rows(rng, 60)
    path = write(f"{_local(tmp_dir)}/f/a.csv", as_csv([["id", "v\nw", "x"], *rows], end).encode())
    keys = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = R.utf8_lines(spark, [path])
        assert lines.select("block").distinct().count() > 1
        got = [(r.kind, r.text) for r in R.read_records(lines, True).collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(list(csv.reader(io.StringIO(t, newline="")))[0] for k, t in got if k == R.WHOLE) == sorted(rows)
    assert [list(csv.reader(io.StringIO(t, newline="")))[0] for k, t in got if k == R.HEADER] == [["id", "v\nw", "x"]] or end == "\r\n" or block == 7


@pytest.mark.parametrize("codec", ["utf-16-le", "utf-16-be"])
@pytest.mark.parametrize("block", [6, 40, 1000])
def test_utf16_ranges_equal_the_whole_read(spark, tmp_dir, codec, block):
    """Code points whose bytes look like a line feed between characters, beside line ends."""
    odd = ["਀", "ੁ", "上", "ਊ", "૿", "Ā", "a", "\n", "\u000a਀", "਀\u000a", "\U0001f60a"]
    rng = random.Random(block)
    text = "".join(rng.choice(odd) for _ in range(400))
    bom = b"\xff\xfe" if codec == "utf-16-le" else b"\xfe\xff"
    path = write(f"{_local(tmp_dir)}/u/a.csv", bom + text.encode(codec))
    size = os.path.getsize(path)
    want = text.split("\n")
    want = want[:-1] if want[-1] == "" else want
    got = [line for a in range(0, size, block) for part in R.lines_of_range(path, a, min(a + block, size), chunk_bytes=10) for line in part]
    assert got == want
    lines = R.utf16_lines(spark, [path], block)
    assert lines.rdd.getNumPartitions() == -(-size // block)  # many tasks read one file
    assert sorted(r.line for r in lines.collect()) == sorted(want)


@pytest.mark.parametrize("codec", ["utf-8", "utf-16"])
def test_visit_values_with_line_breaks(spark, tmp_dir, codec):
    rows = [[str(i), "2", "3", "2010-01-01", "2010-01-02", "4", "5", "6", v] for i, v in enumerate(["plain", "two\nlines", 'q"\n\n"', "", ",\n,", "end\n"])]
    write(f"{_local(tmp_dir)}/v/a.csv", as_csv([NEEDED.split(","), *rows]).encode(codec))
    write(f"{_local(tmp_dir)}/v/b.csv", as_csv([NEEDED.split(","), [*["9"] * 3, "2011-01-01", "", "1", "", "", "whole"]]).encode(codec))
    raw = read_visits_csv(spark, [VisitFile(f"{tmp_dir}/v", True)])
    got = {r.visit_occurrence_id: r.visit_source_value for r in clean.clean_visits(raw).collect()}
    assert got == {0: "plain", 1: "two\nlines", 2: 'q"\n\n"', 3: "UNKNOWN", 4: ",\n,", 5: "end\n", 9: "whole"}


def test_only_files_with_open_quotes_are_read_by_records(spark, tmp_dir):
    d = _local(tmp_dir)
    write(f"{d}/m/a b+c%.csv", b'x,"y\nz"\n')
    write(f"{d}/m/b.csv", b'x,"y z"\nq,a"b\n')
    assert [p.rsplit("/", 1)[1] for p in R.broken_files(spark, [f"{tmp_dir}/m"])] == ["a b+c%.csv"]
    assert R.broken_files(spark, [f"{tmp_dir}/m/b.csv"]) == []


def test_a_header_that_differs_raises(spark, tmp_dir):
    names = NEEDED.split(",")
    row = ["1", "2", "3", "2010-01-01", "2010-01-02", "4", "5", "6", "a\nb"]
    write(f"{_local(tmp_dir)}/h/a.csv", as_csv([names, row]).encode())
    write(f"{_local(tmp_dir)}/h/b.csv", as_csv([names[::-1], row]).encode())
    with pytest.raises(Exception, match="CSV header"):
        read_visits_csv(spark, [VisitFile(f"{tmp_dir}/h", True)]).agg(F.count_if(F.col("person_id").isNotNull())).collect()


def test_a_quote_that_never_closes(spark, tmp_dir):
    """What follows an open quote is one record, to the file's end; other files are not touched."""
    d = _local(tmp_dir)
    path = write(f"{d}/o/a.csv", b'1,a\n2,"b\n3,c\n4,d')
    got = R.read_records(R.utf8_lines(spark, [path]), False).collect()
    assert sorted(r.text for r in got) == ["1,a", '2,"b\n3,c\n4,d']


def test_states_over_lines_equal_one_by_one():
    """Ends of random lines and the states after them, against one character after another."""
    import numpy as np
    import pyarrow as pa

    def slow(line, state):  # field's beginning, text, quoted, quote in quoted
        for c in line:
            if state == "quoted":
                state = "quote" if c == '"' else "quoted"
            elif c == '"' and state in ("begin", "quote"):
                state = "quoted"
            else:
                state = "begin" if c == "," else "text"
        return state == "quoted"

    rng = random.Random(5)
    lines = ["".join(rng.choice('"",a é') for _ in range(rng.randrange(9))) for _ in range(3000)]
    ends = R.line_ends(pa.array(lines))
    assert ends[0].tolist() == [slow(x, "begin") for x in lines]
    assert ends[1].tolist() == [slow(x, "quoted") for x in lines]
    for inside in (False, True):
        want, state = [], inside
        for a, b in zip(*ends):
            state = bool(b if state else a)
            want.append(state)
        assert R.states_after(ends, inside).tolist() == want
    assert R.states_after((np.zeros(0, bool), np.zeros(0, bool)), True).tolist() == []


def test_quoted_lines_are_looked_through_once(spark, tmp_dir, monkeypatch):
    """Files that all have open quotes: one scan tells which they are and where their blocks begin."""
    from vistra.sources import csv as C

    rows = [[str(i), "2", "3", "2010-01-01", "2010-01-02", "4", "5", "6", "two\nlines"] for i in range(3)]
    write(f"{_local(tmp_dir)}/w/a.csv", as_csv([NEEDED.split(","), *rows]).encode())
    scans, scan = [], R.block_states
    monkeypatch.setattr(R, "block_states", lambda lines: scans.append(1) or scan(lines))
    got = C.read_visits_csv(spark, [VisitFile(f"{tmp_dir}/w", True)]).select("visit_source_value").collect()
    assert [r[0] for r in got] == ["two\nlines"] * 3 and len(scans) == 1


def test_written_times_equal_formatted_ones(spark):
    """Every form, of usual and odd years, with nulls."""
    from vistra import fixtures

    times = ["1994-02-03 04:05:06.000070", "2001-12-31 23:59:59.9", "1000-01-01 00:00:00", "0999-01-02 03:04:05", None]
    rows = spark.createDataFrame([(t, k) for t in times for k in [*range(9), 10**12, None]], "t string, k bigint").withColumn("t", F.col("t").cast("timestamp_ntz"))
    rows = rows.withColumn("plain", F.col("t").cast("string"))
    got = rows.select(fixtures.written_times("t", "k", "plain").alias("a"), fixtures._formatted_times("t", "k").alias("b")).collect()
    assert all(r.a == r.b for r in got) and len({r.a for r in got}) > 40


def test_lines_move_no_text_of_times(spark):
    """The join of lines and orders moves a line's date, not the text made of it."""
    from vistra import fixtures

    plan = fixtures.visits_raw(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "end_text" not in plan.split("Join Inner")[1]
