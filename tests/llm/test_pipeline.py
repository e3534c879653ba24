"""The stages against plain rules on a small fixture."""

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import table
from tests.llm.test_decontamination import brute as brute_leaks
from tests.llm.test_jaccard import brute as brute_components
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_tokens import ids_of
from vistra.llm import quality
from vistra.llm.common import stored

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "t-" + name.replace(" ", "-"))
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_order_and_columns(spark, outputs):
    names = spark.read.parquet(f"{SF}/documents.parquet").schema
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "personal data", "packing"]
    for df in outputs[:-1]:
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in names]


def test_quality_keeps_what_the_operator_keeps(spark, outputs):
    kept = {r.doc_id for r in quality.op8_quality_rules(spark, SF).filter("kept").collect()}
    assert set(rows(outputs[0])) == kept
    labels = table("labels", SF).set_index("doc_id").quality
    docs = table("documents", SF)
    good = [i for i in docs.doc_id if labels.get(i) == 1 and i in kept]
    assert len(good) > 0.9 * (labels == 1).sum()


def test_one_document_of_each_group_stays(outputs):
    before, after = rows(outputs[0]), rows(outputs[1])
    components = brute_components([(i, r.text) for i, r in before.items()])
    assert set(after) == {i for i, n, c in components if i == c}
    assert all(after[i] == before[i] for i in after)


def test_leaks_go_and_clean_documents_stay(outputs):
    before, after = rows(outputs[1]), rows(outputs[2])
    items = table("benchmark", SF)
    leaks = brute_leaks([(i, r.text) for i, r in before.items()], list(zip(items.item_id.tolist(), items.text)))
    assert leaks
    assert set(after) == set(before) - {k for k, _ in leaks}


def test_personal_data_is_masked(outputs):
    before, after = rows(outputs[2]), rows(outputs[3])
    assert set(after) == set(before)
    for i, r in after.items():
        assert not [s for s in brute_spans(r.text)]
        assert r.n_chars == len(r.text)
        if not brute_spans(before[i].text):
            assert r.text == before[i].text


def test_packing_holds_every_token(outputs):
    docs, pieces = rows(outputs[3]), outputs[4].collect()
    assert sum(p.length for p in pieces) == sum(len(ids_of(r.text, 1)) for r in docs.values())
    used = np.bincount([p.sequence_id for p in pieces], weights=[p.length for p in pieces])
    assert used.max() <= 2048 and (used > 0).all()


def test_run_gives_the_last_stage(spark, outputs):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, outputs[-1].select("doc_id", "start", "length", "ids_crc32").collect())
    )


def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs):
    docs = spark.createDataFrame(odd_docs.selectExpr("doc_id", "text", "lang", "lang source", "part n_chars").collect(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for start in (docs, docs.limit(0)):
        out = start
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stored(stage(spark, out, SF), "t-odd")
        assert (out.count() > 0) == (start.count() > 0)
    assert corpus_pipeline.quality_stage(spark, docs, SF).columns == docs.columns
    # rows without words are no duplicates of each other; equal rows are
    kept = [r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()]
    assert sorted(k for k in kept if k is not None) == [0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 10] and kept.count(None) == 1
