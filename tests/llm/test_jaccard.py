"""Components against a brute-force join over all pairs."""

import random
import re
import time
from pathlib import Path

import numpy as np
import pytest

from tests.llm.conftest import SF, table
from vistra.llm import jaccard
from vistra.llm.common import CLEANUP, discard, stored
from vistra.session import scratch_path


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    seen = set()
    for group in where.values():
        for a in range(len(group)):
            for b in group[a + 1 :]:
                if (group[a], b) not in seen:
                    seen.add((group[a], b))
                    x, y = sets[group[a]], sets[b]
                    if 100 * len(x & y) >= 75 * len(x | y):
                        parent[root(b)] = root(group[a])
    low = {}
    for i, (key, _) in enumerate(rows):
        if sets[i] and key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return sorted(((k, len(s), low.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_op7_on_documents(spark, sf):
    docs = table("documents", sf)
    assert got(jaccard.op7_jaccard_join(spark, sf)) == brute(list(zip(docs.doc_id.tolist(), docs.text)))


def planted(seed):
    """Chains of edits, a passage shared by otherwise different texts, copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, passage = [], [word() for _ in range(30)]
    for _ in range(12):
        text = [word() for _ in range(rng.randint(25, 60))]
        for _ in range(rng.randint(1, 9)):  # each a small edit of the one before
            rows.append(" ".join(text))
            text = list(text)
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 3))]
    rows += [" ".join([word() for _ in range(rng.randint(0, 12))] + passage + [word() for _ in range(rng.randint(0, 12))]) for _ in range(40)]
    rows += [rows[0], rows[0].upper(), "a b", "A  b", "a b c", ""]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, block", [(1, jaccard.BLOCK_SHINGLES), (2, 150)])
def test_chains_shared_passages_and_copies(spark, seed, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)  # small blocks: regions of many groups
    rows = planted(seed)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id bigint, text string, node bigint, shingles string").repartition(3)
    assert got(jaccard.near_duplicates(df)) == brute(rows)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(jaccard.near_duplicates(odd_docs)) == brute(rows)
    assert jaccard.near_duplicates(odd_docs.limit(0)).count() == 0


def test_link_cells_finds_a_link_between_any_two_cells_that_have_one():
    rng = random.Random(3)
    for _ in range(60):
        base = [rng.sample(range(60), 24) for _ in range(3)]
        sets = [np.array(sorted({x if rng.random() > 0.12 else 100 + rng.randrange(40) for x in rng.choice(base)})) for _ in range(30)]
        cells = np.array([rng.randrange(8) for _ in sets])
        source = np.array([rng.random() < 0.5 for _ in sets])
        links = jaccard.link_cells(cells, source, ~source, sets, 75)

        def joined(pairs):
            label = cells.copy()
            for a, b in pairs:
                label[label == label[a]] = label[b]
            return [[x == y for y in label] for x in label]

        near = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))
        every = [(a, b) for a in np.flatnonzero(source) for b in np.flatnonzero(~source) if near(a, b)]
        assert all(near(a, b) for a, b in links)
        assert joined(links) == joined(every)


def test_components_of_a_long_chain(spark):
    n = 50
    links = spark.createDataFrame([((7 * i) % 53, (7 * (i + 1)) % 53) for i in range(n)], "a bigint, b bigint")
    assert {r.label for r in jaccard.components(links).collect()} == {0}


def scratch(spark):
    folder = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_files_that_nothing_reads_any_more_are_deleted(spark):
    before = scratch(spark)
    df = spark.createDataFrame(planted(5), "doc_id bigint, text string")
    found = jaccard.near_duplicates(df)
    left = sorted(name.rpartition("-")[0] for name in scratch(spark) - before)
    assert set(left) <= {"jaccard-sets", "jaccard-nodes", "jaccard-labels"}, left
    assert len(left) <= 5  # not the labels of all rounds
    assert found.count() == df.count()


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {p for d in dirs for p in Path(d.getPath()).rglob("shuffle_*")}
    before, setting = files(), spark.conf.get(CLEANUP, None)
    df = stored(spark.range(1000).repartition(4, "id"), "t-shuffled")
    for _ in range(50):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(CLEANUP, None) == setting and df.count() == 1000
    discard(df)
    assert not Path(df._stored_at.removeprefix("file:")).exists()


def test_large_regions_meet_only_sizes_that_allow_a_link(spark):
    sizes = range(1, 700)
    rows = spark.createDataFrame([(1, n, n % 3 > 0) for n in sizes], "region bigint, n bigint, minor boolean")
    size = {r["n"]: r["size"] for r in jaccard.size_classes(rows, 75).collect()}
    assert all(abs(size[a] - size[b]) <= 1 for a in sizes for b in sizes if 100 * min(a, b) >= 75 * max(a, b))
    two = spark.createDataFrame([(1, 3 * jaccard.BLOCK_SHINGLES, True, 9), (1, jaccard.BLOCK_SHINGLES, False, 5)], "region bigint, n bigint, minor boolean, size bigint")
    assert [tuple(r) for r in jaccard.size_blocks(two).collect()] == [(1, 9, 3, 3)]
