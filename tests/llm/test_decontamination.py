"""Alignment against a plain table, and planted copies against all pairs."""

import random

import numpy as np
import pytest

from tests.llm.conftest import SF, table
from vistra.llm import decontamination as d


def plain_score(item, text):
    best, before = 0, [0] * (len(text) + 1)
    for x in item:
        row = [0]
        for j, y in enumerate(text):
            row.append(max(0, before[j] + (d.MATCH if x == y else d.OTHER), before[j + 1] + d.GAP, row[j] + d.GAP))
        best, before = max(best, max(row)), row
    return best / (d.MATCH * len(item))


def test_alignment_is_smith_waterman():
    rng = random.Random(4)
    items = [np.array([rng.randint(1, 6) for _ in range(rng.randint(3, 20))]) for _ in range(300)]
    texts = [np.array([rng.randint(0, 6) for _ in range(rng.randint(1, 40))]) for _ in range(300)]
    for x, t, (score, a, b) in zip(items, texts, d.align_spans(items, texts, 0.3)):
        assert score == pytest.approx(plain_score(x.tolist(), t.tolist()))
        if score >= 0.3:  # the span alone holds the whole alignment
            assert plain_score(x.tolist(), t[a:b].tolist()) == pytest.approx(score)


def brute(docs, items, least=d.LEAST_SCORE):
    found = {}
    items = [(i, d.WordCodes.words(t or "")) for i, t in items]
    items = [(i, w) for i, w in items if len(w) >= d.SEED_WORDS]
    for key, text in docs:
        words = d.WordCodes.words(text or "")
        own = set(words)
        for i, item in items:
            if len(own & set(item)) * 2 >= len(set(item)) * least:  # a cheap bound on what can be aligned
                s = plain_score(item, words)
                if s >= least:
                    found[key, i] = round(s, 9)
    return found


def test_op4_on_documents(spark):
    docs, items = table("documents"), table("benchmark")
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in d.op4_decontamination(spark, SF).collect()}
    assert got == brute(list(zip(docs.doc_id.tolist(), docs.text)), list(zip(items.item_id.tolist(), items.text)))


def edited(rng, words, share):
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            continue
        out.append("edited" + w if r < 2 * share / 3 else w)
        if r > 1 - share / 3:
            out.append("added")
    return out


@pytest.mark.parametrize("block_chars", [300, 2_000_000])
def test_edited_copies_are_found_and_clean_text_is_not(spark, block_chars):
    rng = random.Random(8)
    word = lambda: rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(20)] + [(90, "a b"), (91, None), (92, "")]
    docs = []
    for k in range(60):
        body = [word() for _ in range(200)]
        if k < 40:
            copy = edited(rng, items[k % 20][1].split(), 0.25 if k >= 20 else 0.0)
            body[100:100] = [w.upper() + "," if k % 3 == 0 else w for w in copy]
        docs.append((k, " ".join(body)))
    docs += [(70, None), (71, ""), (72, "short"), (None, items[3][1])]
    df = spark.createDataFrame([(*x, "e") for x in docs], "doc_id bigint, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in d.find_leaks(df, bench, block_chars=block_chars).collect()}
    want = brute(docs, items)
    assert got == want
    assert {k for k, _ in got if k is not None} == set(range(40))
    left = {r.doc_id for r in d.drop_leaks(df, bench, block_chars=block_chars).collect()}
    assert left == {*range(40, 60), 70, 71, 72}


def test_copies_edited_where_n_grams_are_rare(spark):
    # the exact copy makes the n-grams that the edits broke the rarer ones
    words = [f"w{i}" for i in range(15)]
    copies = [" ".join(f"new{k}x{i}" if i in (2, 6, 10, 14) else w for i, w in enumerate(words)) for k in range(30)]
    docs = list(enumerate([" ".join(words), *copies, "w0 w1 w2 and other words"]))
    items = [(1, " ".join(words))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in d.find_leaks(df, bench).collect()}
    assert got == brute(docs, items)
    assert {k for k, _ in got} == set(range(31))
    assert [r.doc_id for r in d.drop_leaks(df, bench).collect()] == [31]


def test_seed_index_is_a_plain_count():
    rng = random.Random(1)
    draw = lambda n, top: np.array([rng.randint(0 if top > 12 else 1, top) for _ in range(n)], dtype=np.int32)
    items = [draw(rng.randint(3, 20), 12) for _ in range(100)]
    index = d.SeedIndex(items, 3)
    for _ in range(200):
        text = draw(rng.randint(3, 40), 14)
        grams = np.intersect1d(d.gram_hashes(text, 3), index.grams)
        want = [
            i for i, x in enumerate(items)
            if np.isin(d.gram_hashes(x, 3), grams).any() and 2 * sum(min((text == w).sum(), (x == w).sum()) for w in set(x.tolist())) >= len(x)
        ]
        assert index.items_of(grams, text, 0.5).tolist() == want


def test_a_common_n_gram_alone_joins_nothing(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(["one of the", *(word() for _ in range(12))])) for i in range(200)]
    docs = [(k, " ".join([word(), "one of the", *(word() for _ in range(40)), "one of the", word()])) for k in range(50)]
    docs += [(50, "before " + items[7][1] + " after"), (51, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = d.passages(df, d.WordCodes([t for _, t in items]), 3, d.LEAST_SCORE, "doc_id", "text").collect()
    assert [(r._key, r["items"]) for r in found] == [(50, [7])]  # not 50 x 200 pairs
    got = d.find_leaks(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == brute(docs, items) == {(50, 7): 1.0}


def test_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(1, "words and more words")], "item_id bigint, text string")
    got = d.find_leaks(odd_docs, bench).collect()
    assert {r.doc_id for r in got} == {9}
    assert d.find_leaks(odd_docs.limit(0), bench).count() == 0
    assert d.find_leaks(odd_docs, bench.limit(0)).count() == 0
    assert d.drop_leaks(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_a_full_batch_takes_little_memory(spark, monkeypatch):
    """The search for passages holds the words of a part of its batch, and finds what rows by themselves give."""
    import tracemalloc

    import pyarrow as pa
    import pyspark

    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    items = [[word() for _ in range(20)] for _ in range(5)]
    texts = [" ".join(word() for _ in range(400)) for _ in range(2500)]
    for i in range(0, 2500, 100):
        texts[i] += " " + " ".join(items[i // 100 % 5]) + " " + texts[i][:50]
    texts[7] = None
    made = []
    monkeypatch.setattr(d, "trimmed", lambda f: made.append(f) or f)
    monkeypatch.setattr(pyspark.Broadcast, "destroy", lambda self: None)
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    d.find_leaks(spark.createDataFrame([(1, "none")], "doc_id bigint, text string"), bench)
    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))
    key = pa.array(range(2500), pa.int64())
    batch = pa.RecordBatch.from_arrays([key, key, pa.array(texts, pa.string())], names=["_key", "text_hash", "_text"])
    tracemalloc.start()
    found = [r for b in made[0](iter([batch])) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert batch.nbytes > 6e6
    assert [r["row"] for r in found] == [r["_key"] for r in found] == list(range(0, 2500, 100))
    alone = [r for b in made[0](batch.slice(i, 1) for i in range(2500)) for r in b.to_pylist()]
    assert found == alone
    assert peak < 2 * batch.nbytes, peak / batch.nbytes
