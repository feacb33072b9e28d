"""Approximate nearest neighbours by inner product: one hierarchical navigable
small-world graph per shard, stored as flat neighbour arrays, shard results
merged.

Equal vectors are one node; the smallest k + 1 ids of a node are kept beside
the index, which is all that a list of k neighbours can use.  A node's vector
gets one more component that makes all norms equal, so that the nearest by
inner product are the nearest by distance.  Graphs grow by batches: every new
point of a batch is searched for at once, in step, over the graph so far.

The index is a table with a row per node: shard, position, id, level, vector,
and its neighbours' positions in all its layers, one after another.  Search
streams a shard's nodes and then the queries, so a task holds one shard.

Defined cases: a vector that is null, empty, zero or has a null or non-finite
component is no node and no query; vectors are compared with those of their own
dimension; repeated rows are rows of their own; empty tables give no row; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import blobs, matrices, rows_of, stacked

LINKS = 16             # neighbours in the upper layers; twice as many in the lowest
EF_BUILD = 64
EF_SEARCH = 96
EXPAND = 4             # beam entries that are expanded in one step
BATCH = 1024
LEAST_SHARDS = 16
SHARD_ROWS = 50_000    # a shard has about as many nodes at most
SEED = 41


def beam(vectors: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple:
    """Positions and similarities of the ``ef`` best found for every query,
    best first (-1 where fewer), by best-first search from ``entry`` in step."""
    m, n = len(queries), len(vectors)
    ids = np.full((m, ef), -1, np.int32)
    sims = np.full((m, ef), -np.inf, np.float32)
    done = np.zeros((m, ef), bool)
    seen = np.zeros((m, n), bool)
    rows = np.arange(m)
    w = min(entry.shape[1], ef)
    s = np.einsum("qd,qkd->qk", queries, vectors[entry[:, :w]])
    s[entry[:, :w] < 0] = -np.inf
    o = np.argsort(-s, axis=1)
    ids[:, :w] = np.take_along_axis(entry[:, :w], o, 1)
    sims[:, :w] = np.take_along_axis(s, o, 1)
    r, c = np.nonzero(ids[:, :w] >= 0)
    seen[r, ids[r, c]] = True
    active = rows
    while len(active):
        a_ids, a_sims, a_done = ids[active], sims[active], done[active]
        free = ~a_done & (a_ids >= 0)
        pick = free & (np.cumsum(free, axis=1) <= EXPAND)
        going = pick.any(axis=1)
        if not going.all():
            active, a_ids, a_sims, a_done, pick = active[going], a_ids[going], a_sims[going], a_done[going], pick[going]
            if not len(active):
                break
        a_done |= pick
        r, c = np.nonzero(pick)
        slot = np.cumsum(pick, axis=1)[r, c] - 1
        nb = np.full((len(active), EXPAND, graph.shape[1]), -1, np.int32)
        nb[r, slot] = graph[a_ids[r, c]]
        nb = np.sort(nb.reshape(len(active), -1), axis=1)
        fresh = nb >= 0
        fresh[:, 1:] &= nb[:, 1:] != nb[:, :-1]
        fresh &= ~seen[active[:, None], np.maximum(nb, 0)]
        width = int(fresh.sum(axis=1).max(initial=0))
        if width:
            o = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
            nb, fresh = np.take_along_axis(nb, o, 1), np.take_along_axis(fresh, o, 1)
            r, c = np.nonzero(fresh)
            seen[active[r], nb[r, c]] = True
            s = np.einsum("qd,qkd->qk", queries[active], vectors[nb])
            s[~fresh] = -np.inf
            nb[~fresh] = -1
            all_ids, all_sims = np.concatenate([a_ids, nb], 1), np.concatenate([a_sims, s], 1)
            all_done = np.concatenate([a_done, np.zeros_like(fresh)], 1)
            o = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
            a_ids, a_sims, a_done = (np.take_along_axis(x, o, 1) for x in (all_ids, all_sims, all_done))
        ids[active], sims[active], done[active] = a_ids, a_sims, a_done
    return ids, sims


def diverse(vectors: np.ndarray, at: np.ndarray, cand: np.ndarray, most: int) -> np.ndarray:
    """For every point ``at`` its neighbours out of ``cand`` (-1: none): a
    candidate is taken if it is nearer to the point than to those taken; places
    left over go to the nearest of the rest."""
    m, c = cand.shape
    v = vectors[np.maximum(cand, 0)]
    s = np.einsum("qd,qkd->qk", vectors[at], v)
    s[cand < 0] = -np.inf
    o = np.argsort(-s, axis=1, kind="stable")
    cand, s = np.take_along_axis(cand, o, 1), np.take_along_axis(s, o, 1)
    v = np.take_along_axis(v, o[:, :, None], 1)
    among = v @ v.transpose(0, 2, 1)
    taken = np.zeros((m, c), bool)
    closest = np.full((m, c), -np.inf, np.float32)  # to those taken
    for j in range(c):
        take = (cand[:, j] >= 0) & (s[:, j] > closest[:, j]) & (taken.sum(axis=1) < most)
        taken[:, j] = take
        closest[take] = np.maximum(closest[take], among[take, :, j])
    rank = np.argsort(np.where(taken, 0, 1) + 2 * (cand < 0), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(cand, rank, 1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((m, most - out.shape[1]), -1, np.int32)], 1)
    return out


def _top(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    k = min(k, s.shape[1])
    o = np.argpartition(-s, k - 1, axis=1)[:, :k]
    out = ids[o].astype(np.int32)
    out[~np.isfinite(np.take_along_axis(s, o, 1))] = -1
    return out


def _layer(vectors: np.ndarray, nodes: np.ndarray, most: int, entries: np.ndarray) -> np.ndarray:
    """Neighbour array (len(vectors) x most) of one layer over ``nodes``.
    ``entries``: a start per node, out of a layer above; -1 for none."""
    graph = np.full((len(vectors), most), -1, np.int32)
    at = 0
    while at < len(nodes):
        new = nodes[at:at + min(BATCH, max(64, at))]
        s = vectors[new] @ vectors[new].T
        np.fill_diagonal(s, -np.inf)
        cand = [_top(s, new, EF_BUILD)] if len(new) > 1 else []
        if at:
            start = entries[new].astype(np.int32)[:, None]
            start = np.where(start >= 0, start, nodes[0])
            start = np.concatenate([start, np.broadcast_to(nodes[:min(at, 4)], (len(new), min(at, 4)))], 1)
            # a start of the layer above may not be in this graph yet
            known = np.zeros(len(vectors), bool)
            known[nodes[:at]] = True
            start = np.where(known[start], start, nodes[0]).astype(np.int32)
            start = np.sort(start, axis=1)
            start[:, 1:][start[:, 1:] == start[:, :-1]] = -1
            cand.append(beam(vectors, graph, vectors[new], start, EF_BUILD)[0])
        if cand:
            graph[new] = diverse(vectors, new, np.concatenate(cand, 1), most)
            # links back, pruned where a list overflows
            a, b = np.repeat(new, most), graph[new].reshape(-1)
            a, b = a[b >= 0], b[b >= 0]
            o = np.argsort(b, kind="stable")
            a, b = a[o], b[o]
            ends, first, count = np.unique(b, return_index=True, return_counts=True)
            for lo in range(0, len(ends), BATCH):
                e, f, n = ends[lo:lo + BATCH], first[lo:lo + BATCH], count[lo:lo + BATCH]
                for width in sorted({min(1 << int(x).bit_length(), 1 << 30) for x in n}):
                    sel = (n < width) & (n >= width // 2)
                    if not sel.any():
                        continue
                    pad = np.arange(width)[None, :]
                    back = np.where(pad < n[sel][:, None], a[np.minimum(f[sel][:, None] + pad, len(a) - 1)], -1)
                    both = np.sort(np.concatenate([graph[e[sel]], back.astype(np.int32)], 1), axis=1)
                    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
                    step = max(1, 4_000_000 // both.shape[1] ** 2)
                    for k in range(0, len(both), step):
                        graph[e[sel][k:k + step]] = diverse(vectors, e[sel][k:k + step], both[k:k + step], most)
        at += len(new)
    return graph


def build(vectors: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, list[np.ndarray]]:
    """Levels of the rows of ``vectors`` (equal norms) and the layers' neighbour
    arrays, lowest first."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    levels = np.floor(-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(np.int64)
    order = rng.permutation(n)
    layers: list[np.ndarray] = []
    entries = np.full(n, -1, np.int64)
    for level in range(int(levels.max(initial=0)), -1, -1):
        nodes = order[levels[order] >= level]
        graph = _layer(vectors, nodes, LINKS * (2 if level == 0 else 1), entries)
        layers.insert(0, graph)
        if level:  # the best found here starts the search below
            for lo in range(0, n, BATCH):
                part = np.arange(lo, min(n, lo + BATCH))
                start = entries[part][:, None]
                start = np.where(start >= 0, start, nodes[0]).astype(np.int32)
                entries[part] = beam(vectors, graph, vectors[part], start, 4)[0][:, 0]
    return levels, layers


def search(vectors: np.ndarray, levels: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, ef: int) -> tuple:
    """Positions and similarities of the ``ef`` best found for every query."""
    out = []
    step = int(max(16, min(BATCH, 64_000_000 // max(1, len(vectors)))))
    for lo in range(0, len(queries), step):
        q = queries[lo:lo + step]
        start = np.full((len(q), 1), int(np.argmax(levels)), np.int32)
        for graph in layers[:0:-1]:
            start = beam(vectors, graph, q, start, 4)[0][:, :1]
        out.append(beam(vectors, layers[0], q, start, ef))
    return tuple(np.concatenate([x[i] for x in out]) for i in (0, 1))


def _scaled(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their largest component, and that component."""
    top = np.abs(v).max(axis=1, keepdims=True)
    top[top == 0] = 1
    return v / top, top[:, 0]


def norm_classes(v: np.ndarray) -> np.ndarray:
    """Class of each row: norms of a class differ by a factor of 2 at most
    (edges halfway between powers of 2, so that unit vectors share one)."""
    unit, top = _scaled(v)
    return np.rint(np.log2(top) + np.log2((unit * unit).sum(axis=1)) / 2).astype(np.int64)


def _augmented(v: np.ndarray, norm_class: int) -> np.ndarray:
    """Rows of one norm class, scaled and lengthened to one norm."""
    v = np.ldexp(v, -norm_class)
    size = (v * v).sum(axis=1)
    rest = np.sqrt(np.maximum(0.0, size.max(initial=0.0) - size))
    return np.concatenate([v, rest[:, None]], 1).astype(np.float32)


def _stretches(classes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(class, first, past the last) of sorted classes."""
    cuts = [0, *(np.flatnonzero(np.diff(classes)) + 1).tolist(), len(classes)]
    return ((int(classes[lo]), lo, hi) for lo, hi in zip(cuts, cuts[1:]) if hi > lo)


def _flat(levels: np.ndarray, layers: list[np.ndarray]) -> list[bytes]:
    return [b"".join(layers[k][i].tobytes() for k in range(int(levels[i]) + 1)) for i in range(len(levels))]


def _layers(levels: np.ndarray, flat: list[bytes]) -> list[np.ndarray]:
    """Neighbour arrays again from the stored rows."""
    out = []
    for k in range(int(levels.max(initial=0)) + 1):
        lo, width = (0, 2 * LINKS) if k == 0 else (LINKS * (k + 1), LINKS)
        graph = np.full((len(levels), width), -1, np.int32)
        for i in np.flatnonzero(levels >= k):
            graph[i] = np.frombuffer(flat[i], np.int32, width, 4 * lo)
        out.append(graph)
    return out


def build_index(nodes: DataFrame, shards: int) -> DataFrame:
    """Index table of ``nodes`` (node, vector): dim, shard, position, node,
    level, vector (doubles), neighbours (32-bit positions), norm_class; written.

    A shard holds a graph for each class of norms, one after the other, with
    neighbours counted from the graph's first position: a few long vectors do
    not take the precision of the links among the others."""
    keyed = nodes.select(F.size("vector").alias("dim"),
                         F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(shards)).cast("int").alias("shard"), "node", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts = None, [], []
        for batch in batches:
            dims, shard = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            names = batch.column(2).to_numpy()
            found = matrices(batch.column(3))
            keys = np.stack([dims, shard], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                now = (int(dims[lo]), int(shard[lo]))
                if key is not None and now != key:
                    yield from emit(key, ids, parts)
                    ids, parts = [], []
                key = now
                rows, m = found[now[0]]
                parts.append(m[(rows >= lo) & (rows < hi)])
                ids.append(names[lo:hi])
        if key is not None:
            yield from emit(key, ids, parts)

    def emit(key: tuple, ids: list, parts: list) -> Iterator[pa.RecordBatch]:
        names, v = np.concatenate(ids), np.concatenate(parts)
        classes = norm_classes(v)
        order = np.lexsort((names, classes))
        names, v, classes = names[order], v[order], classes[order]
        graphs = [build(_augmented(v[lo:hi], c)) for c, lo, hi in _stretches(classes)]
        levels, flat = np.concatenate([g[0] for g in graphs]), [x for g in graphs for x in _flat(*g)]
        for lo in range(0, len(names), 8192):
            s = slice(lo, lo + 8192)
            m = len(names[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * m, pa.int32()), pa.array([key[1]] * m, pa.int32()),
                 pa.array(np.arange(lo, lo + m)), pa.array(names[s]), pa.array(levels[s]), blobs(v[s]),
                 pa.array(flat[s], pa.binary()), pa.array(classes[s])],
                ["dim", "shard", "position", "node", "level", "vector", "neighbours", "norm_class"])

    out = (keyed.repartitionByRange(shards, "shard", "dim").sortWithinPartitions("dim", "shard", "node")
           .mapInArrow(run, "dim int, shard int, position long, node long, level long, vector binary, neighbours binary, norm_class long"))
    return written(out, "index")


def search_index(index: DataFrame, queries: DataFrame, shards: int, k: int, ef: int = EF_SEARCH) -> DataFrame:
    """(query_id, node, score): the k nearest nodes found in every shard for
    ``queries`` (query_id, vector); the score is the inner product in doubles.
    Queries go to all shards, in batches."""
    def as_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, (rows, m) in matrices(batch.column(1)).items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(rows), pa.int32()), batch.column(0).take(pa.array(rows)), blobs(m)],
                    ["dim", "node", "vector"])

    asked = (queries.select("query_id", "vector").mapInArrow(as_blobs, "dim int, node long, vector binary")
             .select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                     F.col("node").alias("position"), "node", F.lit(0).cast("long").alias("level"), "vector",
                     F.lit(None).cast("binary").alias("neighbours"), F.lit(0).cast("long").alias("norm_class")))
    both = index.select("dim", "shard", F.lit(0).alias("kind"), "position", "node", "level", "vector", "neighbours",
                        "norm_class").union(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, graph = None, [], None
        for batch in batches:
            head = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
            cuts = [0, *(np.flatnonzero((head[1:] != head[:-1]).any(axis=1)) + 1).tolist(), len(head)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                part, (dim, shard, kind) = batch.slice(lo, hi - lo), head[lo].tolist()
                if (dim, shard) != key:
                    key, held, graph = (dim, shard), [], None
                if kind == 0:
                    held.append((part.column(4).to_numpy(), part.column(5).to_numpy(), stacked(part.column(6), "f8"),
                                 part.column(7).to_pylist(), part.column(8).to_numpy()))
                elif held or graph:
                    if graph is None:
                        names, levels, v, classes = (np.concatenate([h[i] for h in held]) for i in (0, 1, 2, 4))
                        flat, graph, held = [x for h in held for x in h[3]], [], []
                        for c, i, j in _stretches(classes):
                            wide = np.concatenate([np.ldexp(v[i:j], -c), np.zeros((j - i, 1))], 1).astype(np.float32)
                            graph.append((names[i:j], v[i:j], wide, levels[i:j], _layers(levels[i:j], flat[i:j])))
                    asked_ids, q = part.column(4).to_numpy(), stacked(part.column(6), "f8")
                    q32 = np.concatenate([_scaled(q)[0], np.zeros((len(q), 1))], 1).astype(np.float32)
                    for names, v, wide, levels, layers in graph:
                        yield best(asked_ids, q, names, v, search(wide, levels, layers, q32, max(ef, k))[0])

    def best(asked_ids: np.ndarray, q: np.ndarray, names: np.ndarray, v: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        ids = ids[:, :max(2 * k, k + 16)]
        exact = np.einsum("qd,qkd->qk", q, v[np.maximum(ids, 0)])
        exact[ids < 0] = -np.inf
        o = np.lexsort((names[np.maximum(ids, 0)], -exact), axis=1)[:, :k]  # ties to the smaller node
        ids, exact = np.take_along_axis(ids, o, 1), np.take_along_axis(exact, o, 1)
        r, c = np.nonzero(ids >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(asked_ids[r]), pa.array(names[ids[r, c]]), pa.array(exact[r, c])], ["query_id", "node", "score"])

    return (both.repartitionByRange(shards, "shard", "dim").sortWithinPartitions("dim", "shard", "kind", "position")
            .mapInArrow(run, "query_id long, node long, score double"))


def nearest(rows: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` its k
    nearest rows of ``rows`` other than itself (by id), by inner product,
    nearest first, equal scores by id.

    A query row that is there several times gives one answer; an id asked with
    several vectors gets each row by its best score."""
    base = rows_of(rows, id_column, vector).select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    same = Window.partitionBy("vector").orderBy("vec_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = written(base.withColumn("n", F.row_number().over(same)).withColumn("node", F.first("vec_id").over(same))
                      .where(F.col("n") <= k + 1), "members")
    nodes = members.where("n = 1").select("node", "vector")
    shards = max(LEAST_SHARDS, -(-nodes.count() // SHARD_ROWS))
    index = build_index(nodes, shards)
    asked = rows_of(queries, id_column, vector).select(F.col(id_column).cast("long").alias("query_id"),
                                                       F.col(vector).alias("vector")).distinct()
    found = search_index(index, asked, shards, k + 1).groupBy("node", "query_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.join(members.select("node", "vec_id"), "node").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
