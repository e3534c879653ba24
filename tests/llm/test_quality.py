"""Rule counts against plain Python, and the forest's verdicts against labels."""

import re
from pathlib import Path

import numpy as np

from tests.llm.conftest import SF, table
from vistra.llm import quality
from vistra.session import scratch_path


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_digits": len(re.findall("[0-9]", text)),
    }


def check(rows, texts):
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts, strict=True):
        want = brute(t)
        assert {k: r[k] for k in want if k in r} == {k: v for k, v in want.items() if k in r}, t
        assert r["base_failed"] == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_counts_of_odd_texts(odd_texts):
    repeats = ["a " * 30, "a b c d e f g h " * 2, "a b c d e f g h i j a b c d e f g h i", "x\n\nx\n y\nx\n\t\n y", "#*$%&|<>&é#"]
    texts = [t or "" for t in [*odd_texts, *repeats]]
    found = quality.statistics(texts)
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in found.items()} == brute(t)
    assert all(len(v) == 0 for v in quality.statistics([]).values())


def test_op8_on_documents(spark):
    docs = table("documents")
    rows = {r["doc_id"]: r for r in (x.asDict() for x in quality.op8_quality_rules(spark, SF).collect())}
    check([rows[i] for i in docs.doc_id], docs.text.tolist())


def test_verdicts_keep_good_rows_and_reject_bad_ones(spark):
    sf = "/root/testdata/sf0.1"
    labels = table("labels", sf).set_index("doc_id").quality
    rows = quality.op8_quality_rules(spark, sf).select("doc_id", "base_failed", "kept").toPandas().set_index("doc_id").join(labels, how="inner")
    passed = rows[~rows.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.995
    assert passed[passed.quality == 0].kept.mean() < 0.1


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 0), (3, 1)], "doc_id bigint, quality int")
    rows = [r.asDict() for r in quality.quality_rules(odd_docs, labels, keep=["doc_id", "text", "part"]).collect()]
    check(rows, [r["text"] for r in rows])
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in rows) == sorted((r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    assert all(r["kept"] != r["base_failed"] for r in rows)  # too few labels: the base rules alone
    assert quality.quality_rules(odd_docs.limit(0), labels.limit(0)).count() == 0


def test_forest_finds_the_odd_rows():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(0, 1, (1000, 3)), rng.normal(9, 1, (10, 3))])
    score = quality.anomaly(quality.fit_forest(rows), rows)
    assert score[1000:].min() > np.quantile(score[:1000], 0.99)


def test_calibration_bounds_the_loss():
    score = np.linspace(0, 1, 1001)
    good = np.arange(1001) < 900
    cut = quality.calibrate(score, good, loss=0.01)
    assert (score[good] > cut).mean() <= 0.01
    assert quality.calibrate(score, np.zeros(1001, bool)) == np.inf


def test_verdicts_are_the_same_whatever_files_hold_the_rows(spark):
    from tests.llm.conftest import SF
    from vistra.llm import quality

    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    verdicts = [
        sorted((r.doc_id, r.kept, r.anomaly_score) for r in quality.quality_rules(docs.repartition(n), labels.repartition(n)).collect()) for n in (1, 32)
    ]
    assert verdicts[0] == verdicts[1]


def test_every_row_has_a_part_in_the_forest(spark, monkeypatch):
    """Of 20,000 rows, more than any draw held before, each one that is odd widens a range of a tree's root."""
    trees = quality.TREES
    roots = {"feature": np.full(trees, -1, np.int32), "cut": np.zeros(trees), "left": np.full(trees, -1), "right": np.full(trees, -1), "roots": np.arange(trees)}
    monkeypatch.setattr(quality, "grow_forest", lambda node_ranges, size: node_ranges(roots, 0))
    for odd in ([], [0], [7_777], [12_345, 19_999]):
        symbols = f"if(id in ({', '.join(map(str, odd))}), 99L, 0L)" if odd else "0L"
        rules = spark.range(20_000).selectExpr(
            "id as _key", "100L as n_words", "500 + id % 37 as word_chars", f"{symbols} as n_symbols", "0L as n_dup_lines", "0L as n_repeat_words", "id % 7 as n_upper", "0L as n_digits"
        )
        found = quality.forest_of(rules, "_key")
        assert len(found) == trees
        assert sum(share[0] > 0 for _, share, *_ in found) == len(odd)
        assert [high[0] for *_, high in found if high[0]] == [0.99] * len(odd)


def test_bad_rows_are_rejected_in_a_forest_of_large_trees(spark, monkeypatch):
    """Some 1,500 rows a tree in groups of 64: verdicts as with trees of 64 rows."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    monkeypatch.setattr(quality, "copies_of", lambda rows: 30)
    rows = quality.quality_rules(spark.read.parquet(f"{sf}/documents.parquet"), labels).filter("not base_failed").join(labels, "doc_id")
    kept = {r[0]: r[1] for r in rows.selectExpr("quality", "cast(kept as int) as kept").groupBy("quality").avg("kept").collect()}
    assert kept[1] > 0.995 and kept[0] < 0.1


def test_the_cut_is_exact_over_all_labelled_rows(spark):
    """30,000 good rows, with ties and one far value: the very value that sorting all of them gives."""
    rng = np.random.default_rng(3)
    score = np.concatenate([np.round(rng.random(20_000), 3), rng.random(9_999) * 1e-9 + 0.5, [0.97]])
    good = np.ones(len(score), bool)
    good[::50] = False
    frame = spark.createDataFrame([(float(x), int(g)) for x, g in zip(score, good)], "anomaly_score double, _quality int").repartition(5)
    assert quality.calibrated_cut(frame) == quality.calibrate(score, good)
    fine = np.sort(score[good])[::-1]
    assert [quality.kth_highest(frame.filter("_quality = 1"), "anomaly_score", k) for k in (0, 1, 15_000, len(fine) - 1)] == [fine[k] for k in (0, 1, 15_000, len(fine) - 1)]
    assert quality.calibrated_cut(frame.filter("_quality = 1")) == np.inf


def test_kept_columns_are_not_stored(spark, odd_docs):
    """Texts to keep are as large as the input."""
    folder = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    labels = spark.createDataFrame([], "doc_id bigint, quality bigint")
    found = quality.quality_rules(odd_docs, labels, keep=odd_docs.columns)
    new = [spark.read.parquet(str(p)).columns for p in set(folder.iterdir()) - before]
    assert new and not any(c.startswith("_keep") for columns in new for c in columns)
    plain = quality.quality_rules(odd_docs, labels)
    key = lambda r: [str(r[c]) for c in plain.columns]
    assert sorted(map(key, found.collect())) == sorted(map(key, plain.collect()))
