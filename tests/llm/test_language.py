"""Forward sums against enumeration, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from tests.llm.conftest import SF, table
from vistra.llm import language


def brute(word, names, p):
    """Sum over all segmentations of the marked word, stray letters included."""
    word = chr(language._START) + word
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            piece = word[start:end]
            if piece in names:
                total[end] += total[start] * p[names[piece]]
        total[end] += total[end - 1] * language.STRAY
    return total[-1]


def test_forward_sums_all_segmentations():
    pieces = language.pieces_of(language.VOCABULARY)
    rng = np.random.default_rng(1)
    probs = rng.dirichlet(np.ones(len(pieces.names)), 2).T
    names = {n: i for i, n in enumerate(pieces.names)}
    words = ["the", "thatedening", "élève", "straße", "x", "中文", "qqqq", "internationalization"]
    got = language.word_scores(words, pieces, probs)
    for w, row in zip(words, got, strict=True):
        assert row == pytest.approx([np.log(brute(w, names, probs[:, k])) for k in range(2)], rel=1e-9)


def test_expected_counts_explain_every_letter():
    pieces = language.pieces_of(language.VOCABULARY)
    p = np.full((len(pieces.names), 1), 1e-4)
    counts = language.expected_counts(["the", "hats"], np.array([3.0, 1.0]), pieces, p)
    letters = sum(c * len(n) for c, n in zip(counts, pieces.names))
    assert letters == pytest.approx(3 * 4 + 5, rel=1e-3)  # less what stray letters take


def test_batch_words():
    names, numbers, first = language.batch_words(["The  the,cat", "", "12 -- ", "É-a"])
    assert [[names[i] for i in numbers[a:b]] for a, b in zip(first, first[1:])] == [["the", "the", "cat"], [], [], ["é", "a"]]


def test_op6_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = table("documents", sf).set_index("doc_id")
    rows = language.op6_language_id(spark, sf).toPandas().set_index("doc_id")
    assert len(rows) == len(docs)
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in rows.held_out.items())
    held = rows[rows.held_out].join(docs.lang)
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_odd_rows(spark, odd_docs):
    docs = table("documents", SF)
    langs, probs = language.fit_tables(spark.createDataFrame(docs[["doc_id", "text", "lang", "n_chars"]]))
    got = language.identify(odd_docs, langs, probs).collect()
    assert len(got) == odd_docs.count()
    none = {r.doc_id for r in got if r.lang_pred == language.UNKNOWN}
    assert {0, 1, 2} <= none and all(r.score == 0 for r in got if r.lang_pred == language.UNKNOWN)
    assert {r.lang_pred for r in language.identify(odd_docs, [], np.zeros((0, 0))).collect()} == {language.UNKNOWN}
    assert language.identify(odd_docs.limit(0), langs, probs).count() == 0
    assert language.fit_tables(odd_docs.limit(0).selectExpr("doc_id", "text", "lang"))[0] == []


def test_long_runs_are_summed_whole():
    """A run of letters over 40, and one over several stretches, against the unsplit sum."""
    pieces = language.pieces_of(language.VOCABULARY)
    rng = np.random.default_rng(1)
    probs = rng.dirichlet(np.ones(len(pieces.names)), 2).T
    names = {n: i for i, n in enumerate(pieces.names)}
    for word in ("thatedening" * 5, "é" * 41, "internationalization" * 2 + "x"):
        got = language.long_word_scores(word, pieces, probs)
        assert got == pytest.approx([np.log(brute(word, names, probs[:, k])) for k in range(2)], rel=1e-9)
        assert got == pytest.approx(language.word_scores([word], pieces, probs)[0], rel=1e-9)
    long = language.long_word_scores("thatening" * 1000, pieces, probs)  # 9,000 letters: far below what a double holds
    logs = []
    for k in range(2):  # the same recursion, one column at a time, in logarithms
        text, total = chr(language._START) + "thatening" * 1000, [0.0]
        for end in range(1, 9002):
            terms = [total[-1] + np.log(language.STRAY)] + [
                total[end - n] + np.log(probs[names[text[end - n : end]], k]) for n in pieces.lengths if n <= end and text[end - n : end] in names
            ]
            total.append(np.logaddexp.reduce(terms))
        logs.append(total[-1])
    assert long == pytest.approx(logs, rel=1e-9)


def test_a_long_run_is_one_word_in_the_prediction(spark):
    docs = table("documents", SF)
    langs, probs = language.fit_tables(spark.createDataFrame(docs[["doc_id", "text", "lang", "n_chars"]]))
    text = "thatedeningwithoutablank" * 4
    pieces = language.pieces_of(language.VOCABULARY)
    row = language.identify(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), langs, probs).first()
    scores = language.long_word_scores(text, pieces, probs)
    assert row.lang_pred == langs[int(scores.argmax())]
    assert row.score == pytest.approx(float(1 / np.exp(scores - scores.max()).sum()))
