import random

import numpy as np
import pytest

from campaignlake.llm import setjoin
from campaignlake.llm.common import written

from .tables import DOCS, docs_frame


def brute_force(rows, n, num, den):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                if a != b:
                    low, high = (a, b) if rows[a][0] < rows[b][0] else (b, a)
                    root[high] = low
    return {rows[i][0]: (len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}


def corpus(seed, sizes, groups=25):
    """Groups of texts that differ in a few words, so that similarities lie on
    both sides of the threshold."""
    rng, rows, at = random.Random(seed), [], 100
    line = [f"line{i}" for i in range(30)]
    for _ in range(groups):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice(sizes))]
        if rng.random() < 0.3:
            base += line  # a passage that many share
        for _ in range(rng.choice([1, 2, 5, 9])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(9999)}"
            rows.append((at, " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,num,den,sizes", [(3, 90, 100, [4, 9, 12, 20, 60, 150]), (5, 80, 100, [5, 8, 12, 16, 30, 90]),
                                             (1, 90, 100, [9, 10, 11, 19, 21])])
@pytest.mark.parametrize("small", [None, 0, 14])
def test_equals_brute_force(spark, monkeypatch, n, num, den, sizes, small):
    if small is not None:  # any boundary gives the same links
        monkeypatch.setattr(setjoin, "boundary", lambda *_: small)
    rows = corpus(n + (small or 0), sizes)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.jaccard_components(df, n, num, den).collect()}
    assert got == brute_force(rows, n, num, den)


@pytest.mark.parametrize("long_list", [50_000, 10])
def test_blocks_of_large_groups(spark, monkeypatch, long_list):
    monkeypatch.setattr(setjoin, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(setjoin, "LONG_LIST", long_list)  # also lists that are never gathered
    base = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join([*base[:i % 70], f"y{i}", *base[i % 70:]])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.jaccard_components(df, 3, 90, 100).collect()}
    assert got == brute_force(rows, 3, 90, 100)


def test_awkward_rows(spark):
    docs = docs_frame(spark)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in setjoin.jaccard_components(docs, 3, 90, 100).collect()]
    assert len(got) == docs.count()
    by = {d: (n, c) for d, n, c in got}
    assert by[4] == (0, 4) and by[5] == (0, 5) and by[6] == (0, 6) and by[7] == (1, 7)
    assert by[8] == (1, 8) and by[9] == (1, 8) and by[2][1] == 1 and by[3][1] == 1 and by[11][1] == 10
    assert by[None] == (3, None) and [x for x in got if x[0] == 12] == [(12, 2, 12)] * 2
    kept = setjoin.one_of_each(docs, 3, 90, 100)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and {1, 4, 5, 6, 7, 8, 10, 12} <= set(ids) and not {2, 3, 9, 11, None} & set(ids)
    assert setjoin.jaccard_components(spark.createDataFrame([], DOCS), 3, 90, 100).count() == 0


def test_boundary_follows_cost():
    rare, frequent = np.zeros(256), np.zeros(256)
    rare[1], frequent[200] = 1e6, 1e4
    sizes = {a: 1000 for a in range(1, 40)}
    assert setjoin.boundary(sizes, rare, 90, 100) <= setjoin.boundary(sizes, frequent, 90, 100)
    assert setjoin.boundary({}, rare, 90, 100) == 0


def test_subset_keys_meet_exactly_when_sets_overlap_enough():
    rng = np.random.default_rng(1)
    pool = setjoin.mix64(np.arange(1, 40, dtype=np.uint64))
    for _ in range(300):
        a = np.sort(rng.choice(pool, rng.integers(1, 16), replace=False))
        b = a.copy() if rng.random() < 0.5 else np.sort(rng.choice(pool, len(a), replace=False))
        if rng.random() < 0.5:
            b[rng.integers(len(b))] = np.uint64(rng.integers(1 << 60))
        common = len(np.intersect1d(a, b))
        linked = 100 * common >= 80 * (len(np.union1d(a, b)))
        meet = len(np.intersect1d(setjoin.subset_keys(a, 80, 100), setjoin.subset_keys(np.unique(b), 80, 100))) > 0
        assert meet or not linked


def test_sets_of_common_shingles_are_no_candidates(spark, monkeypatch):
    # every shingle is in many texts, so no order of single shingles has rare ones first
    rng, placed = random.Random(5), []
    rows = [(i, " ".join(f"v{rng.randrange(10)}" for _ in range(90))) for i in range(300)]
    rows += [(300 + i, rows[i][1] + " end") for i in range(10)]

    def counted(df, name):
        out = written(df, name)
        if name == "placed":
            placed.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "written", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.jaccard_components(df, 3, 90, 100).collect()}
    assert got == brute_force(rows, 3, 90, 100)
    assert 20 <= placed[0] < 60


@pytest.mark.parametrize("num,den", [(80, 100), (90, 100), (50, 100)])
def test_list_keys_meet_when_sets_are_similar(num, den):
    rng = np.random.default_rng(2)
    pool, lows = setjoin.mix64(np.arange(1, 4000, dtype=np.uint64)), setjoin.bracket_lows(num, den)
    linked = unlinked = 0
    for size in [1, 2, 3, 5, 8, 13, 20, 40, 41, 90, 200, 400] * 25:
        a = np.sort(rng.choice(pool, size, replace=False))
        b = np.union1d(rng.choice(a, rng.integers(max(1, size * num // den), size + 1), replace=False),
                       rng.choice(pool, rng.integers(0, size // 4 + 1)))
        levels = [(s % np.uint64(7)).astype(np.uint8) for s in (a, b)]
        keys = [np.concatenate(setjoin.list_keys(s, level, lows, num, den)) for s, level in zip((a, b), levels, strict=True)]
        if den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b)):
            linked += 1
            assert len(np.intersect1d(*keys))
        other = np.sort(rng.choice(pool, size, replace=False))
        unlinked += len(np.intersect1d(a, other)) > 0
    assert linked > 50 and unlinked > 50


def test_tied_keys_hand_on_one_node():
    keys = np.array([5, 1, 5, 9, 5, 1], np.uint64)
    at, low, edges = setjoin.tied(keys, np.array([3, 7, -2, 4, 8, 7], np.int64))
    assert at.tolist() == [1, 5, 9] and low.tolist() == [7, -2, 4]
    assert edges.tolist() == [[-2, 3], [-2, 8]]
    at, low, edges = setjoin.tied(np.empty(0, np.uint64), np.empty(0, np.int64))
    assert not len(at) and not len(low) and edges.shape == (0, 2)
