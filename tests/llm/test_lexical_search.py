"""Ranked search against a plain scorer; ties, copies, odd rows, blocks of items."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF, table
from vistra.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    """(id, text) rows -> {item: [(rank, doc_id, score)]}; the stated formulas, one document at a time."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, Counter()).update(terms(text))
    out = {}
    for item, c in wanted.items():
        found = []
        for doc, b, n in bags:
            m = 75 + 25 * n * n_docs // length
            s = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 12 * m)) for t, x in c.items() if t in b)
            if s > 0:
                found.append((-s, doc is None, doc or 0, doc))
        found.sort(key=lambda r: r[:3])
        if found:
            out[item] = [(r + 1, f[3], -f[0]) for r, f in enumerate(found[:k])]
    return out


def as_dict(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.item_id, r.rank)):
        out.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    return out


def test_registered_query_against_brute_force(spark):
    docs, items = table("documents"), table("benchmark")
    got = as_dict(L.op11_lexical_search(spark, SF).collect())
    assert got == brute(list(zip(docs.doc_id.tolist(), docs.text)), list(zip(items.item_id.tolist(), items.text)))


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def test_random_texts_with_many_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(30)] + ["Éa", "éa", "x1", "CAT", "cat", "中文"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 12))) for _ in range(60)]
    docs = [(int(i), texts[j]) for i, j in enumerate(np.minimum(rng.zipf(1.3, 900) - 1, 59))]
    docs = [docs[i] for i in rng.permutation(len(docs))]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 9)))) for i in range(25)]
    d, q = frames(spark, docs, items)
    assert as_dict(L.search(d.repartition(7), q).collect()) == brute(docs, items)
    assert as_dict(L.search(d.repartition(2), q, k=3).collect()) == brute(docs, items, 3)


def test_blocks_of_items_give_the_same(spark):
    docs = [(i, f"a{i % 5} b{i % 3} c") for i in range(100)]
    items = [(i, f"a{i % 5} b{i % 4}") for i in range(40)]
    d, q = frames(spark, docs, items)
    assert as_dict(L.search(d, q, block_chars=1200).collect()) == brute(docs, items)
    with pytest.raises(ValueError):
        L.search(d, q.limit(1), block_chars=10)


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, None), (2, ""), (3, "one thin words"), (None, "one"), (4, "É éa ß 中文 same key"), (4, "null key here"), (5, "%% --")]
    q = spark.createDataFrame([(*i, "x", 0) for i in items], "item_id bigint, text string, class string, score int")
    assert as_dict(L.search(odd_docs.withColumn("score", odd_docs.part), q).collect()) == brute(docs, items)


def test_nothing(spark):
    d, q = frames(spark, [(1, "a b")], [(1, "a")])
    for docs, items in ((d.limit(0), q), (d, q.limit(0)), (d, q.filter("item_id > 1"))):
        found = L.search(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_hot_class_is_cut_before_the_shuffle(spark):
    """A third of the rows hold one text: they are one class, and 20 of them are an item's result."""
    docs = [(i, "same old text" if i % 3 == 0 else f"other words {i}") for i in range(3000)]
    d, q = frames(spark, docs, [(1, "old text"), (2, "words")])
    assert as_dict(L.search(d.repartition(4), q).collect()) == brute(docs, [(1, "old text"), (2, "words")])
