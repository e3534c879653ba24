"""Codes of vectors against plain rounds in whole numbers; bounds spare distances and change nothing."""

import math

import numpy as np
import pytest

from tests.llm.conftest import SF
from vistra.llm import vector_codes as V


def brute(rows, entries=256, rounds=4):
    """rows (id, vector, label) -> sorted (id, code, error, label_error) and codebooks."""
    kept = [(i, np.array([math.floor(1024 * x) for x in v], np.int64), lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    if not kept:
        return [], []
    x = np.stack([v for _, v, _ in kept]).reshape(len(kept), 4, -1)
    books = [x[:entries, p].copy() for p in range(4)]

    def nearest(p):
        far = ((x[:, p][:, None, :] - books[p][None]) ** 2).sum(axis=2)
        own = far.argmin(axis=1)
        return own, far[np.arange(len(x)), own]

    for _ in range(rounds):
        for p in range(4):
            own, _ = nearest(p)
            for e in range(len(books[p])):
                if (own == e).any():
                    books[p][e] = x[own == e, p].sum(axis=0) // (own == e).sum()
    owns, fars = zip(*[nearest(p) for p in range(4)])
    error = sum(fars)
    per_label = {}
    for (_, _, lab), e in zip(kept, error):
        per_label[lab] = per_label.get(lab, 0) + int(e)
    return [(i, "".join(f"{o[r]:02x}" for o in owns), int(error[r]), per_label[lab]) for r, (i, _, lab) in enumerate(kept)], books


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def run(spark, rows, ddl="vec_id bigint, embedding array<float>, label int"):
    import pandas  # noqa: F401

    from vistra.llm import vector_codes

    df = spark.createDataFrame(rows, ddl).repartition(3)
    saved = vector_codes.table
    vector_codes.table = lambda *_: df
    try:
        return vector_codes.op13_vector_codes(spark, "").collect()
    finally:
        vector_codes.table = saved


def check(spark, rows, ddl="vec_id bigint, embedding array<float>, label int"):
    got = run(spark, rows, ddl)
    want, books = brute(rows)
    assert ordered([(r.vec_id, r.code, r.error, r.label_error) for r in got]) == ordered(want)
    assert {r.codebooks_sha256 for r in got} == ({V.books_digest(books)} if want else set())


def singles(x):
    return np.asarray(x, np.float32).astype(float).tolist()


def test_random_vectors_in_clumps(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 1500)] + rng.normal(scale=0.1, size=(1500, 16))
    check(spark, [(int(i) * 3 + 5, singles(v), int(i) % 4 if i % 9 else None) for i, v in enumerate(x)])


def test_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, singles(rng.integers(-2, 3, 8) / 1024), 1) for i in range(900)]
    rows += [(i + 1000, singles(np.ones(8)), 2) for i in range(500)]
    check(spark, rows)


def test_odd_rows(spark):
    v = [0.5, -0.25, 0.1, 0.0]
    rows = [(1, v, None), (1, v, None), (None, [1.0, 2.0, 3.0, 4.0], 7), (2, None, 7), (3, [None, 1.0, 1.0, 1.0], 7), (4, [float("nan"), 1.0, 1.0, 1.0], 7)]
    rows += [(5, [float("inf"), 1.0, 1.0, 1.0], 7), (6, [-0.0001, 0.9999, -1.0, 0.0], 7)]
    check(spark, rows)
    check(spark, rows[3:4])
    assert run(spark, rows[:1]) and V.compress(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int"))[0].collect() == []


def test_other_lengths_and_empty_vectors(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)])
    with pytest.raises(ValueError):
        run(spark, [(1, [1.0] * 6, 1)])
    check(spark, [(1, [], 1), (2, [], 1)])


def test_clashing_columns_and_other_types(spark):
    rows = [(i, [float(i), 1.0, 0.5, 0.25], "x", 3) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string, error int").withColumnRenamed("error", "ids")
    coded, _ = V.compress(df)
    assert sorted(r.vec_id for r in coded.collect()) == [0, 1, 2, 3, 4]


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    check(spark, [(i, singles(rng.normal(scale=3000, size=8)), 0) for i in range(400)])


def test_bounds_spare_distances():
    """After the first round most rows keep their entry without a look at others; the answer is that of all distances."""
    rng = np.random.default_rng(3)
    centres = rng.normal(scale=1000, size=(64, 16))
    x = np.floor(centres[rng.integers(0, 64, 4000)] + rng.normal(scale=150, size=(4000, 16))).astype(np.int64)
    books, before = x[:64].copy(), x[:64].copy()
    state, looked = V.PartState.fresh(len(x), V.FIRST_LISTED), []
    for _ in range(8):
        steps = np.sqrt(((books - before) ** 2).sum(axis=1).astype(float)) * (1 + 1e-12)
        best, failed, measured = state.nearest(x, books, steps)
        far = ((x[:, None, :] - books[None]) ** 2).sum(axis=2)
        assert (state.own == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
        # an entry's least bound in the list, or the outer one where it isn't listed, is no more than its distance
        least, listed = np.full(far.shape, np.inf), np.zeros(far.shape, bool)
        rows = np.arange(len(x))[:, None]
        np.minimum.at(least, (rows, state.listed.astype(int)), state.bounds)
        listed[rows, state.listed.astype(int)] = True
        bound = np.where(listed, least, state.outer[:, None])
        bound[rows[:, 0], state.own] = 0
        assert (bound <= np.sqrt(far) + 1e-3).all()
        assert (state.bounds[:, 1:] >= state.bounds[:, :-1]).all()
        looked.append(measured)
        again, rest_ = V.PartState.unpack(memoryview(state.pack()))
        assert len(rest_) == 0 and (again.bounds == state.bounds).all() and (again.listed == state.listed).all()
        before, books = books, np.stack([x[state.own == e].sum(axis=0) // max((state.own == e).sum(), 1) if (state.own == e).any() else books[e] for e in range(64)])
    assert looked[0] == 4000 * 64 and looked[-1] < looked[0] / 5


def test_registered_query_against_brute_force(spark):
    import pandas as pd

    frame = pd.read_parquet(f"{SF}/embeddings.parquet")
    got = V.op13_vector_codes(spark, SF).collect()
    want, books = brute([(int(i), v, lab) for i, v, lab in zip(frame.vec_id, frame.embedding, frame.label)])
    assert ordered([(r.vec_id, r.code, r.error, r.label_error) for r in got]) == ordered(want)
    assert got[0].codebooks_sha256 == V.books_digest(books)
