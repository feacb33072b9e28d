import math

import numpy as np
import pytest

from campaignlake.llm import neardup, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, node string, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k, "x", "x")
                                  for i, v, k in rows], SCHEMA).repartition(3)


def clusters(seed=0, n=500, d=24):
    """Vectors in clusters of near copies of several widths, with equal ones."""
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    while at < n:
        base = rng.standard_normal(d)
        for _ in range(rng.choice([1, 1, 2, 6, 40])):
            v = base + rng.standard_normal(d) * rng.choice([0.0, 0.1, 0.25, 0.4])
            rows.append((at * 3 % 1009, v.astype(np.float32), int(rng.integers(3))))
            at += 1
    return rows


BAD = [(5001, None, 1), (5002, [], 1), (5003, [0.0] * 24, 1), (5004, [math.nan] * 24, 1), (5005, [math.inf] + [0.0] * 23, 1),
       (5006, [None] + [1.0] * 23, 1), (5007, [1.0, 2.0], 1), (5008, [2.0, 4.0], 1), (None, [1.0] * 24, 1)]


def exact_links(rows, threshold):
    ids = [r[0] for r in rows]
    v = np.stack([np.asarray(r[1], np.float64) for r in rows])
    u = v / np.linalg.norm(v, axis=1)[:, None]
    label = np.array([-1 if r[2] is None else r[2] for r in rows])
    a = (u @ u.T >= threshold) & (label[:, None] == label[None, :]) & (label >= 0)[:, None]
    np.fill_diagonal(a, False)
    low = np.array(ids)
    while True:
        new = np.array([min(low[i], low[a[i]].min(initial=low[i])) for i in range(len(ids))])
        if (new == low).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, a.sum(axis=1), low)}
        low = new


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    rows = clusters()
    rows += [(6000 + i, rows[7][1], rows[7][2]) for i in range(30)] + [(7000, rows[7][1], None)]
    for block in (1024, 16):  # also with buckets in blocks
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = {r["vec_id"]: r for r in neardup.near_duplicates(frame(spark, rows + BAD), 0.93).collect()}
        want = exact_links(rows, 0.93)
        assert {k: (got[k]["n_links"], got[k]["component_id"]) for k in want} == want
        assert got[7000]["n_links"] == 0 and all(got[k]["kept"] == (c == k) for k, (_, c) in want.items())
        for i in range(5001, 5007):
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
        assert (got[5007]["n_links"], got[5008]["component_id"]) == (1, 5007)  # a dimension of their own
    assert neardup.near_duplicates(frame(spark, []), 0.93).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    d = 64
    u = rng.standard_normal((400, d))
    u[200:] = u[:200] + 0.4 * u[200:]
    u /= np.linalg.norm(u, axis=1)[:, None]
    turns = neardup.rotations(d, 2)
    assert np.allclose(turns @ turns.transpose(0, 2, 1), np.eye(d), atol=1e-5)
    codes, factors = neardup.encode(u, turns)
    turned = np.einsum("rde,ne->nrd", turns, u.astype(np.float32))
    upper = neardup.upper_bounds(codes, factors, turned, d)
    spread = np.sqrt(((1 - factors ** 2) / factors ** 2).sum(axis=1)) / 2 * neardup.EPS0 / np.sqrt(d - 1)
    error = upper - spread[:, None] - u @ u.T
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 0.005
    assert (upper >= u @ u.T).mean() > 0.9999


def test_bands_reach_the_recall():
    for n in (10, 5000, 10**6, 10**9):
        bits, tables = neardup.bands(n, 0.93)
        assert (1 - (1 - math.acos(0.93) / math.pi) ** bits) ** tables <= neardup.MISS


def exact_nearest(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    v = np.stack([np.asarray(r[1], np.float64) for r in rows])
    out = {}
    for i, q, _ in queries:
        s = v @ np.asarray(q, np.float64)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_nearest_recall_and_order(spark):
    rows = clusters(2, 900)
    rows = list({r[0]: r for r in rows}.values())
    rows += [(8000 + i, rows[5][1] * 2, 0) for i in range(40)]  # equal, and the longest: many ties
    queries = [r for r in rows if r[0] % 20 == 0]
    df = frame(spark, rows + BAD)
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact_nearest(rows, queries, 20)
    found = 0
    for q, best in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1])) and q not in [m[1] for m in mine]
        scores = dict(best)
        assert all(m[2] == pytest.approx(scores[m[1]], rel=1e-12) for m in mine if m[1] in scores)
        found += len({m[1] for m in mine} & set(scores))
    assert found >= 0.95 * 20 * len(want)


def test_nearest_of_few_and_none(spark):
    rows = [(20, [1.0, 0.0], 0), (21, [2.0, 0.0], 0), (40, [0.0, 1.0], 0)]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"])
                 for r in neighbours.nearest(frame(spark, rows), frame(spark, rows).where("vec_id % 20 = 0"), 20).collect())
    assert got == [(20, 1, 21, 2.0), (20, 2, 40, 0.0), (40, 1, 20, 0.0), (40, 2, 21, 0.0)]
    none = frame(spark, [])
    assert neighbours.nearest(none, none, 20).count() == 0


def test_graph_keeps_flat_arrays():
    rng = np.random.default_rng(5)
    v = rng.standard_normal((1500, 16)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1)[:, None]
    levels, layers = neighbours.build(v)
    again = neighbours._layers(levels, neighbours._flat(levels, layers))
    assert all((a == b).all() for a, b in zip(layers, again, strict=True)) and len(layers) == levels.max() + 1
    ids, _ = neighbours.search(v, levels, layers, v[:200], 64)
    best = np.argsort(-(v[:200] @ v.T), axis=1)[:, :20]
    assert np.mean([len(set(a[:20]) & set(b)) / 20 for a, b in zip(ids, best)]) > 0.95


@pytest.mark.parametrize("long", [1.0, 1e4, 1e6])
def test_nearest_with_a_long_vector_and_repeated_queries(spark, long, monkeypatch):
    # one shard, far larger than the beam
    monkeypatch.setattr(neighbours, "LEAST_SHARDS", 1)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 24))
    v = centres[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[7] *= long
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    queries = rows.where("vec_id % 40 = 0").union(rows.where("vec_id = 40"))
    got = {}
    for r in neighbours.nearest(rows, queries, 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(got) == list(range(0, 3000, 40))
    hit = 0
    for q, found in got.items():
        score = v @ v[q]
        score[q] = -np.inf
        hit += len({i for _, i in found} & set(np.argsort(-score, kind="stable")[:20].tolist()))
        assert sorted(k for k, _ in found) == list(range(1, 21)) and len({i for _, i in found}) == 20
    assert hit / (20 * len(got)) >= 0.95
