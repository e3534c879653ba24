"""File boundary: encodings, CSV reading, manifest, Parquet, metrics, range."""

import os

import pytest

from vistra.operators import clean
from vistra.sources.csv import VisitFile, read_person_csv, read_visits_csv, write_csv
from vistra.sources.encoding import UTF8, UTF16, detect_encodings, encoding_of_prefix
from vistra.sources.manifest import MissingInputError, input_manifest, manifest_total, require_inputs
from vistra.sources.metrics import metrics_record, read_metrics, write_metrics
from vistra.sources.parquet import read_parquet, write_parquet


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_bom_rule():
    assert encoding_of_prefix(b"\xff\xfeab") == UTF16
    assert encoding_of_prefix(b"\xfe\xff") == UTF16
    assert encoding_of_prefix(b"\xef\xbb\xbfa") == UTF8
    assert encoding_of_prefix(b"") == UTF8


def test_utf16_person_file_needs_multiline(spark, tmp_dir):
    d = _local(tmp_dir)
    os.makedirs(d, exist_ok=True)
    text = "person_id,gender_source_value,race_source_value,extra\r\n1,F,a,z\r\n2,M,b,z\r\n 3 ,F,c,z\r\n"
    path = os.path.join(d, "person.csv")
    with open(path, "wb") as f:
        f.write(text.encode("utf-16"))  # BOM + native order
    found = detect_encodings(spark, [path])
    assert set(found.values()) == {UTF16}
    rows = sorted(clean.person_dim(read_person_csv(spark, path, found)).collect())
    assert [(r.person_id, r.gender_source_value) for r in rows] == [(1, "F"), (2, "M"), (3, "F")]
    garbage = (
        spark.read.option("header", True).option("encoding", "UTF-16").csv(path).collect()
    )
    assert [tuple(r) for r in garbage] != [tuple(r) for r in rows]


def test_visit_csv_headed_and_headerless_stack_by_name(spark, tmp_dir):
    from vistra.schema import RAW_VISIT_SCHEMA, VISIT_COLUMNS

    def row(i):
        d = dict.fromkeys(VISIT_COLUMNS)
        d.update(visit_occurrence_id=str(i), person_id=str(i), visit_start_datetime="2010-01-01 00:00:00",
                 visit_source_value="NA" if i == 2 else "OP")
        return tuple(d[c] for c in VISIT_COLUMNS)

    a = spark.createDataFrame([row(1), row(2)], RAW_VISIT_SCHEMA)
    b = spark.createDataFrame([row(3)], RAW_VISIT_SCHEMA)
    write_csv(a, f"{tmp_dir}/v0", header=True)
    write_csv(b, f"{tmp_dir}/v1", header=False)
    raw = read_visits_csv(spark, [VisitFile(f"{tmp_dir}/v0", True), VisitFile(f"{tmp_dir}/v1", False)])
    got = sorted((r.visit_occurrence_id, r.visit_source_value) for r in clean.clean_visits(raw).collect())
    assert got == [(1, "OP"), (2, "UNKNOWN"), (3, "OP")]


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write("\n".join(lines) + "\n")


NEEDED = "visit_occurrence_id,person_id,visit_concept_id,visit_start_datetime,visit_end_datetime,visit_type_concept_id,provider_id,care_site_id,visit_source_value"


def test_headed_columns_go_by_name(spark, tmp_dir):
    d = _local(tmp_dir)
    names = NEEDED.split(",")
    turned = ["extra", *reversed(names)]
    values = dict(zip(names, ["1", "2", "3", "2010-01-01", "2010-01-02", "4", "5", "6", "OP"]), extra="e,e")
    _write(f"{d}/turned/a.csv", [",".join(turned), ",".join(f'"{values[c]}"' for c in turned)])
    r = clean.clean_visits(read_visits_csv(spark, [VisitFile(f"{d}/turned", True)])).first()
    assert (r.visit_occurrence_id, r.person_id, r.provider_id, r.visit_source_value, r.visit_duration_days) == (1, 2, 5, "OP", 1.0)


def test_a_header_that_differs_or_lacks_a_column_raises(spark, tmp_dir):
    from vistra.sources.csv import MissingColumnsError

    d = _local(tmp_dir)
    _write(f"{d}/lacks/a.csv", [NEEDED.replace("person_id,", ""), "1,3,2010-01-01,2010-01-02,4,5,6,OP"])
    with pytest.raises(MissingColumnsError):
        read_visits_csv(spark, [VisitFile(f"{d}/lacks", True)])
    row = "1,2,3,2010-01-01,2010-01-02,4,5,6,OP"
    _write(f"{d}/two/a.csv", [NEEDED, row])
    _write(f"{d}/two/b.csv", [",".join(reversed(NEEDED.split(","))), row])
    with pytest.raises(Exception, match="CSV header"):
        clean.clean_visits(read_visits_csv(spark, [VisitFile(f"{d}/two", True)])).collect()


def test_quotes_are_doubled_and_backslash_is_text(spark, tmp_dir):
    from vistra.sources.csv import malformed_rows

    d = _local(tmp_dir)
    values = ['"say ""hi"", ok"', '"C:\\"', '"a\\""b"', "plain"]
    _write(f"{d}/quotes/a.csv", [NEEDED, *(f"{i},2,3,2010-01-01,2010-01-02,4,5,6,{v}" for i, v in enumerate(values))])
    files = [VisitFile(f"{d}/quotes", True)]
    rows = clean.clean_visits(read_visits_csv(spark, files)).orderBy("visit_occurrence_id").collect()
    assert [r.visit_source_value for r in rows] == ['say "hi", ok', "C:\\", 'a\\"b', "plain"]
    assert tuple(malformed_rows(spark, files).first()) == (0, 4)
    _write(f"{d}/broken/a.csv", [NEEDED, "1,2,3", "1,2,3,2010-01-01,2010-01-02,4,5,6,OP,more", "1,2,3,2010-01-01,2010-01-02,4,5,6,OP"])
    assert tuple(malformed_rows(spark, [VisitFile(f"{d}/broken", True)]).first()) == (2, 3)


def test_clean_schema(spark):
    from vistra.schema import CLEAN_VISIT_SCHEMA, RAW_VISIT_SCHEMA

    out = clean.clean_visits(spark.createDataFrame([], RAW_VISIT_SCHEMA)).schema
    assert [(f.name, f.dataType) for f in out] == [(f.name, f.dataType) for f in CLEAN_VISIT_SCHEMA]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from vistra.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_manifest_and_missing_input(spark, tmp_dir):
    write_csv(spark.createDataFrame([("1",)], "a string"), f"{tmp_dir}/person.csv")
    m = input_manifest(spark, tmp_dir, ["person.csv", "visit_occurrence_0.csv"])
    rows = {r.file_name: r for r in m.collect()}
    assert rows["person.csv"].present and rows["person.csv"].size_bytes > 0
    assert not rows["visit_occurrence_0.csv"].present and rows["visit_occurrence_0.csv"].n_files == 0
    total = manifest_total(m).first()
    assert (total.present, total.missing) == (1, 1)
    assert total.total_bytes == rows["person.csv"].size_bytes
    with pytest.raises(MissingInputError):
        require_inputs(m)
    require_inputs(input_manifest(spark, tmp_dir, ["person.csv"]))


def test_parquet_round_trip_overwrites(spark, tmp_dir):
    write_parquet(spark.range(10), f"{tmp_dir}/p")
    write_parquet(spark.range(3), f"{tmp_dir}/p")
    assert read_parquet(spark, f"{tmp_dir}/p").count() == 3


def test_metrics_json_round_trip(spark, tmp_dir):
    yearly = spark.createDataFrame([(2001, 5), (2000, 7)], "visit_year int, visit_count long")
    rec = metrics_record(yearly, 1.23456, [{"shuffle_partitions": 8, "pipeline_seconds": 2.0,
                                            "comparison_seconds": 0.5}])
    write_metrics(rec, f"{tmp_dir}/m")
    back = read_metrics(spark, f"{tmp_dir}/m").first()
    assert back.ingest.pipeline_seconds == 1.235
    assert back.comparison_results == {"2000": 7, "2001": 5}
    assert back.spark_configurations[0].shuffle_partitions == 8
    assert back.shuffle_configurations == [8]


def test_range_source_smoke(spark):
    assert spark.range(5).count() == 5


def test_mixed_encodings_are_read_per_group(spark, tmp_dir):
    from vistra.sources.encoding import read_groups

    d = _local(tmp_dir)
    os.makedirs(f"{d}/mix", exist_ok=True)
    head = "person_id,gender_source_value,race_source_value\r\n"
    with open(f"{d}/mix/a.csv", "wb") as f:
        f.write((head + "1,F,a\r\n").encode("utf-16"))
    with open(f"{d}/mix/b.csv", "wb") as f:
        f.write((head + "2,M,b\r\n").encode("utf-8"))
    groups = read_groups(spark, [f"{d}/mix"])
    assert [e for e, _ in groups] == sorted([UTF8, UTF16])
    rows = sorted(clean.person_dim(read_person_csv(spark, f"{d}/mix", groups=groups)).collect())
    assert [(r.person_id, r.gender_source_value) for r in rows] == [(1, "F"), (2, "M")]
    same = read_groups(spark, [f"{d}/mix/b.csv"])
    assert same == [(UTF8, [f"{d}/mix/b.csv"])]


def test_utf16_visit_file_is_spread_before_cleaning(spark, tmp_dir):
    from vistra.schema import VISIT_COLUMNS

    d = _local(tmp_dir)
    os.makedirs(f"{d}/v16", exist_ok=True)
    lines = [",".join(VISIT_COLUMNS)]
    for i in range(200):
        row = dict.fromkeys(VISIT_COLUMNS, "")
        row.update(visit_occurrence_id=str(i), person_id=str(i % 7), visit_start_datetime="2010-01-01 00:00:00",
                   visit_end_datetime="2010-01-02 00:00:00")
        lines.append(",".join(row[c] for c in VISIT_COLUMNS))
    with open(f"{d}/v16/visits.csv", "wb") as f:
        f.write(("\r\n".join(lines) + "\r\n").encode("utf-16"))
    raw = read_visits_csv(spark, [VisitFile(f"{d}/v16", True)], spread=3)
    assert raw.rdd.getNumPartitions() == 3  # one file, yet not one task
    stated = read_visits_csv(spark, [VisitFile(f"{d}/v16", True, "UTF-16")])
    assert stated.count() == 200
    got = clean.clean_visits(raw)
    assert got.count() == 200 and got.agg({"visit_duration_days": "max"}).first()[0] == 1.0


def test_read_groups_many_keeps_roots_apart(spark, tmp_dir):
    from vistra.sources.encoding import read_groups_many

    d = _local(tmp_dir)
    for sub in ("plain", "mixed"):
        os.makedirs(f"{d}/{sub}", exist_ok=True)
    with open(f"{d}/plain/a.csv", "wb") as f:
        f.write(b"x\r\n1\r\n")
    with open(f"{d}/plain/b.csv", "wb") as f:
        f.write(b"x\r\n2\r\n")
    with open(f"{d}/mixed/c.csv", "wb") as f:
        f.write("x\r\n3\r\n".encode("utf-16"))
    with open(f"{d}/mixed/d.csv", "wb") as f:
        f.write(b"x\r\n4\r\n")
    plain, mixed = read_groups_many(spark, [f"{d}/plain", f"{d}/mixed"])
    assert plain == [(UTF8, [f"{d}/plain"])]  # one encoding: read as given, no paths collected
    assert sorted(e for e, _ in mixed) == sorted([UTF8, UTF16])
    by_enc = dict(mixed)
    assert [p.rsplit("/", 1)[1] for p in by_enc[UTF16]] == ["c.csv"]
    assert [p.rsplit("/", 1)[1] for p in by_enc[UTF8]] == ["d.csv"]


def test_a_write_that_fails_leaves_the_table(spark, tmp_dir):
    from pyspark.sql import functions as F

    from vistra.sources.parquet import versions

    path = f"{tmp_dir}/table"
    for n in (3, 4, 5):
        write_parquet(spark.range(n), path)
        assert read_parquet(spark, path).count() == n
    bad = spark.range(0, 1000, 1, 4).withColumn("id", F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("halfway")).cast("bigint")))
    with pytest.raises(Exception, match="halfway"):
        write_parquet(bad, path)
    assert read_parquet(spark, path).count() == 5
    assert len(versions(spark, path)) == 2  # the current one and the one before it
    write_parquet(read_parquet(spark, path).unionByName(spark.range(1)), path)  # a table may be read while it is replaced
    assert read_parquet(spark, path).count() == 6
    write_parquet(spark.range(8), path)  # clears what the failed write left
    folder = f"{_local(path)}/_versions"
    assert len(os.listdir(folder)) == 2


def test_a_plain_folder_is_read_and_replaced(spark, tmp_dir):
    path = f"{tmp_dir}/plain"
    spark.range(7).write.parquet(path)
    assert read_parquet(spark, path).count() == 7
    write_parquet(spark.range(2), path, partition_by=())
    assert read_parquet(spark, path).count() == 2
    assert sorted(n for n in os.listdir(_local(path)) if not n.startswith(("_", "."))) == []


def test_manifest_lists_a_thousand_paths_in_one_job(spark, tmp_dir):
    d = _local(tmp_dir)
    for i in range(0, 1000, 100):
        os.makedirs(f"{d}/in/f{i}", exist_ok=True)
        for part in range(2):
            with open(f"{d}/in/f{i}/part {part}", "wb") as f:
                f.write(b"x" * (i + 1))
    names = [f"f{i}" for i in range(1000)] + ["odd{,}[*"]
    sc = spark.sparkContext
    sc.setJobGroup("manifest", "listing")
    try:
        manifest = input_manifest(spark, f"{tmp_dir}/in", names)
        assert len(sc.statusTracker().getJobIdsForGroup("manifest")) <= 1
    finally:
        sc.setJobGroup("", "")
    rows = {r.file_name: r for r in manifest.collect()}
    assert len(rows) == 1001 and {n for n, r in rows.items() if r.present} == {f"f{i}" for i in range(0, 1000, 100)}
    assert (rows["f300"].n_files, rows["f300"].size_bytes) == (2, 602)


def test_loss_report_counts_in_the_ingest_pass(spark, tmp_dir):
    from vistra.plans import visits as job

    d = _local(tmp_dir)
    rows = ["1,2,3,2010-01-01,2010-01-02,4,5,6,OP", ",2,3,2010-01-01,x,4,5,6,OP", "1,,3,nope,2010-01-02,4,5,6,OP", "1,2,3,,,4,5,6,OP", "1,2,3,2010-01-01,soon,4,5,6,OP"]
    _write(f"{d}/loss/a.csv", [NEEDED, *rows])
    job.ingest(spark, [VisitFile(f"{tmp_dir}/loss", True)], f"{tmp_dir}/out", loss_dir=f"{tmp_dir}/report")
    found = {r.reason: r.rows for r in read_parquet(spark, f"{tmp_dir}/report").collect()}
    assert found == {"rows_read": 5, "no_visit_id": 1, "no_person_id": 1, "no_start": 1, "unreadable_start": 1, "dropped": 3, "kept_unreadable_end": 1}
    assert read_parquet(spark, f"{tmp_dir}/out").count() == 2
