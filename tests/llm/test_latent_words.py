"""Hidden Markov model: recursions against enumeration, counts against brute force, held-out gain."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from tests.llm.conftest import SF, table
from vistra.llm import latent_words as L
from vistra.llm.common import Words


def small_model(seed=1, states=L.STATES):
    rng = np.random.default_rng(seed)
    emit = np.zeros((L.CLASSES, states))
    emit[:5] = rng.dirichlet(np.ones(5), states).T
    return L.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), emit)


def plain_forward(model, classes):
    state, total = model.first * model.emit[classes[0]], 0.0
    for c in classes[1:]:
        total += math.log10(state.sum())
        state = (state / state.sum()) @ model.move * model.emit[c]
    return total + math.log10(state.sum())


def test_likelihood_is_the_sum_over_all_state_paths():
    model = small_model(states=3)
    for seq in ([0], [1, 4], [2, 2, 0, 3, 1]):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(seq)):
            p = model.first[path[0]] * model.emit[seq[0], path[0]]
            for a, b, c in zip(path, path[1:], seq[1:]):
                p *= model.move[a, b] * model.emit[c, b]
            total += p
        got = model.log10_likelihood(np.array(seq), np.array([len(seq)]))
        assert np.isclose(got[0], math.log10(total), rtol=1e-12)


def test_likelihood_of_many_and_of_long_sequences(monkeypatch):
    monkeypatch.setattr(L, "LONG", 40)
    monkeypatch.setattr(L, "STRETCH", 7)
    model, rng = small_model(), np.random.default_rng(3)
    sizes = np.array([1, 39, 40, 41, 42, 49, 200, 2000, 3, 7 * 256 + 1])
    classes = rng.integers(0, 5, sizes.sum())
    got = model.log10_likelihood(classes, sizes)
    for g, part in zip(got, np.split(classes, np.cumsum(sizes)[:-1])):
        assert np.isclose(g, plain_forward(model, part), rtol=1e-12)


def test_expected_counts_against_enumeration():
    model = small_model(states=2)
    seqs = [[0, 1, 1, 2, 4, 3, 0, 0, 1, 2, 2], [3], [4, 0]]
    opening = np.array([True, False, True])
    sums = [np.zeros(2), np.zeros((2, 2)), np.zeros((L.CLASSES, 2))]
    sizes = np.array([len(s) for s in seqs])
    likely = model.expected(np.concatenate(seqs), np.cumsum(sizes) - sizes, sizes, opening, sums)
    want = [np.zeros(2), np.zeros((2, 2)), np.zeros((L.CLASSES, 2))]
    total = 0.0
    for seq, opens in zip(seqs, opening):
        paths = list(itertools.product(range(2), repeat=len(seq)))
        p = np.array([
            model.first[q[0]] * model.emit[seq[0], q[0]] * np.prod([model.move[a, b] * model.emit[c, b] for a, b, c in zip(q, q[1:], seq[1:])])
            for q in paths
        ])
        total += math.log10(p.sum())
        for q, w in zip(paths, p / p.sum()):
            want[0][q[0]] += w * opens
            for a, b in zip(q, q[1:]):
                want[1][a, b] += w
            for c, a in zip(seq, q):
                want[2][c, a] += w
    assert np.isclose(likely, total)
    for a, b in zip(sums, want):
        assert np.allclose(a, b)


def test_a_round_never_lowers_the_likelihood():
    rng = np.random.default_rng(5)
    classes, sizes = np.repeat([0, 1, 2, 3], 50) + rng.integers(0, 2, 200), np.full(20, 10)
    model, before = small_model(2), -np.inf
    for _ in range(15):
        sums = [np.zeros(L.STATES), np.zeros((L.STATES, L.STATES)), np.zeros((L.CLASSES, L.STATES))]
        now = model.expected(classes, np.cumsum(sizes) - sizes, sizes, np.ones(20, bool), sums)
        assert now >= before - 1e-9
        before = now
        model = L.Model(sums[0] / sums[0].sum(), sums[1] / sums[1].sum(axis=1, keepdims=True), sums[2] / sums[2].sum(axis=0))


def test_pieces_cover_every_token_once():
    sizes = np.array([1, 256, 257, 1000, 3])
    start, size, opens = L.pieces_of(sizes, np.ones(5, bool))
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(start, size)])
    assert sorted(covered) == list(range(sizes.sum())) and opens.sum() == 5 and size.max() <= L.PIECE


def test_squeezed_numbers_come_back():
    values = np.array([0, 1, 255, 256, 70_000, (1 << 24) - 1], np.int64)
    assert L.unsqueezed(L.squeezed(values)).tolist() == values.tolist()
    assert len(L.unsqueezed(L.squeezed(values[:0]))) == 0


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(rows):
    """doc rows (id, text) -> {id: (held, n_tokens, n_known, N, base)} by the stated formulas."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = [(i, [*words_of(t), None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held[i], len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens]


def check_base(got, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got = sorted([tuple(r)[:6] for r in got], key=key)
    want = sorted(brute_base(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_base_columns_and_gain_on_held_out_texts(spark):
    docs = table("documents")
    got = L.op12_latent_word_scores(spark, SF).collect()
    check_base(got, list(zip(docs.doc_id.tolist(), docs.text.tolist())))
    held = [r for r in got if r.held_out]
    assert held and all(np.isfinite(r.score) and r.score < 0 for r in got)
    # the model beats the base on texts that it hasn't seen
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_TOKENS", 50)
    got = L.score_texts(odd_docs.repartition(3)).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_base(got, rows)
    assert all(np.isfinite(r.score) for r in got)


def test_repeated_rows_score_alike_and_no_rows_give_none(spark, odd_docs):
    got = [r for r in L.score_texts(odd_docs).collect() if r.doc_id == 3 and r.n_tokens == 3]
    assert len(got) == 2 and got[0].score == got[1].score
    assert L.score_texts(odd_docs.limit(0)).collect() == []


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:4]
    got = L.score_texts(spark.createDataFrame([(i, "some words") for i in ids], "doc_id bigint, text string")).collect()
    assert {(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(True, 3, 0, 0, 0.0)}
    assert all(np.isfinite(r.score) for r in got)


def test_clashing_columns_and_types(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6), (2, None, 5, 6)], "doc_id int, text string, score int, block int")
    assert sorted(r.doc_id for r in L.score_texts(docs).collect()) == [1, 2]


def test_probabilities_of_one_token_sum_to_one(spark):
    """Over known words and one unknown word for each spelling class."""
    docs = spark.createDataFrame([(i, f"alpha beta beta w{i} w{i % 7}") for i in range(300)], "doc_id bigint, text string")
    blocks = L.number_words(docs, "doc_id", "text")
    counts = L.count_words(blocks)
    voc = L.Vocabulary(counts)
    model = L.train(L.class_tokens(blocks, counts, voc), voc, 1)
    found = counts.toPandas()
    classes = voc.classes(found["word"].to_numpy())
    inner = np.where(classes >= L.OWN_SHARE, (found["c"] + 1) / (voc.c + voc.v + 1)[np.maximum(classes - L.OWN_SHARE, 0)], 1.0)
    first = model.emit @ model.first
    unknown = (first[L.OWN_SHARE :] / (voc.c + voc.v + 1)).sum()
    unused = first[len(voc.own) : L.OWN_SHARE].sum()
    assert np.isclose((first[classes] * inner).sum() + unknown + unused, 1.0) and unused < 1e-12


def test_names_of_words():
    words = Words(["One two two three", "one", ""], lower=True)
    names = L.word_names(words)
    assert len(set(names.tolist())) == 3 and names[0] == names[4] and names[1] == names[2]
    assert (L.spelling(names) < L.SPELLINGS).all()


def test_model_learns_two_kinds_of_text(spark):
    """Texts of two kinds without a common word: the model tells them apart, single words don't."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        kind = "ab"[i % 2]
        rows.append((i, " ".join(f"{kind}{x}" for x in rng.integers(0, 40, 60))))
    got = pd.DataFrame(L.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), columns=L.score_texts(spark.createDataFrame(rows[:1], "doc_id bigint, text string")).columns)
    held = got[got.held_out]
    gain = (held.score - held.base_score).sum() / held.n_tokens.sum()
    assert gain > 0.25  # log10(2) = 0.30 a word is what knowing the kind is worth
