"""Embedding near-duplicates by randomised-rotation binary codes (RaBitQ, Gao
and Long, 2024).

Each vector, made of length one, is turned by a few fixed random rotations; the
signs are its code.  Stored with a code is the inner product of the vector and
its code's unit vector.  It corrects the estimate <code, other> / <code, own>
of a cosine, which is unbiased; its error is below eps0 * sqrt((1 - f^2) / f^2
/ (d - 1)) but for a vanishing chance, f being the stored factor.  Only pairs
whose upper bound reaches the threshold are computed again in doubles, from the
original vectors.

Pairs meet in tables: bands of the code's bits.  The bits of a band follow from
the number of vectors, so that a bucket of unrelated vectors stays small, and
the number of tables from the chance ``MISS`` of missing a pair that lies just
at the threshold.  A bucket that copies fill is split into blocks and compared
block by block; a pair that meets in several tables counts in the first.  Pairs
are never emitted: a task returns link counts by vector and a spanning forest.

Equal vectors of a label are one node with a weight.  Defined cases: a null
id or label, or a vector that is null, empty, zero or has a null or non-finite
component, links with nothing; vectors of different dimension never link;
repeated rows are copies of one another; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, connected_components, written
from .vectors import blobs, matrices, stacked, usable

MISS = 1e-4        # chance of missing a pair at the threshold
EPS0 = 4.0         # confidence of the bound
BUCKET = 128       # unrelated vectors in a bucket
BLOCK = 1024       # rows of a block
MOST_HOT = 100_000
SEED = 29


def rotations(d: int, count: int) -> np.ndarray:
    """``count`` random rotations of d dimensions, the same everywhere."""
    rng = np.random.default_rng(SEED + d)
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((d, d)))
        out.append(q * np.sign(np.diag(r)))
    return np.stack(out).astype(np.float32)


def bands(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a band and number of tables for n vectors of one label."""
    same = 1 - acos(threshold) / pi  # chance that a bit agrees at the threshold
    bits = min(24, max(2, round(log2(max(4, n / BUCKET)))))
    return bits, ceil(log(MISS) / log(1 - same ** bits))


def encode(units: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x rotations * d, booleans) and factors (rows x rotations)."""
    turned = np.einsum("rde,ne->nrd", turns, units.astype(np.float32))
    factors = np.abs(turned).sum(axis=2) / np.sqrt(units.shape[1])
    return (turned > 0).reshape(len(units), -1), factors


def band_keys(codes: np.ndarray, bits: int, tables: int) -> np.ndarray:
    weights = (1 << np.arange(bits)).astype(np.int64)
    return codes[:, :bits * tables].reshape(len(codes), tables, bits) @ weights


def upper_bounds(codes: np.ndarray, factors: np.ndarray, turned: np.ndarray, d: int) -> np.ndarray:
    """Upper bounds of the cosines of coded rows (left) with rotated rows."""
    r = factors.shape[1]
    signs = np.where(codes, 1, -1).astype(np.float32).reshape(len(codes), r, d)
    scaled = signs / (np.sqrt(d) * np.maximum(factors, 1e-9))[:, :, None] / r
    estimate = scaled.reshape(len(codes), -1) @ turned.reshape(len(turned), -1).T
    spread = np.sqrt((np.maximum(0.0, 1 - factors ** 2) / np.maximum(factors, 1e-9) ** 2).sum(axis=1)) / r
    margin = EPS0 * spread / np.sqrt(d - 1) if d > 1 else np.full(len(codes), np.inf)
    return estimate + margin[:, None] + 1e-4  # single precision


def _group_links(v: np.ndarray, keys: np.ndarray, codes: np.ndarray, factors: np.ndarray, left: np.ndarray,
                 right: np.ndarray, table: int, threshold: float, turns: np.ndarray, same: bool) -> tuple:
    """Links between the rows ``left`` and ``right`` (positions) that meet in
    ``table`` first."""
    d = v.shape[1]
    units = v / np.linalg.norm(v, axis=1)[:, None]
    a_out, b_out = [], []
    for lo in range(0, len(left), BLOCK):
        a = left[lo:lo + BLOCK]
        for ro in range(lo if same else 0, len(right), BLOCK):
            b = right[ro:ro + BLOCK]
            turned = np.einsum("rde,ne->nrd", turns, units[b].astype(np.float32))
            i, j = np.nonzero(upper_bounds(codes[a], factors[a], turned, d) >= threshold)
            i, j = a[i], b[j]
            if same:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 100_000):
                p, q = i[k:k + 100_000], j[k:k + 100_000]
                first = ~(keys[p, :table] == keys[q, :table]).any(axis=1)
                p, q = p[first], q[first]
                hit = np.einsum("nd,nd->n", units[p], units[q]) >= threshold
                a_out.append(p[hit])
                b_out.append(q[hit])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *a_out]), np.concatenate([empty, *b_out])


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position that the links reach, for every position."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def codes_table(nodes: DataFrame, threshold: float, bits: int, tables: int) -> DataFrame:
    """Written index: node, copies, label, dim, vector (doubles), code (packed
    bits), factors (singles), keys (a bucket per table)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, (rows, m) in matrices(batch.column(3)).items():
                if d not in turns:
                    turns[d] = rotations(d, -(-bits * tables // d))
                for lo in range(0, len(rows), 4096):
                    r, v = rows[lo:lo + 4096], m[lo:lo + 4096]
                    codes, factors = encode(v / np.linalg.norm(v, axis=1)[:, None], turns[d])
                    keys = band_keys(codes, bits, tables)
                    at = pa.array(r)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(at) for c in range(3)), pa.array([d] * len(r), pa.int32()), blobs(v),
                         blobs(np.packbits(codes, axis=1)), blobs(factors.astype("f4")),
                         pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1, dtype=np.int32) * tables),
                                                  pa.array(keys.reshape(-1)))],
                        ["node", "copies", "label", "dim", "vector", "code", "factors", "keys"])

    kind = nodes.schema["label"].dataType.simpleString()
    out = nodes.select("node", "copies", "label", "vector").mapInArrow(
        run, f"node long, copies long, label {kind}, dim int, vector binary, code binary, factors binary, keys array<long>")
    return written(out, "codes")


def link_counts(codes: DataFrame, threshold: float) -> DataFrame:
    """(node, n, low): of every bucket block the linked vectors of a node, by
    weight, and the smallest node its links reach there; written."""
    met = codes.select("*", F.posexplode("keys").alias("tab", "bucket"))
    full = met.groupBy("label", "dim", "tab", "bucket").count().where(F.col("count") > 2 * BLOCK)
    full = bounded_broadcast(written(full, "full"), MOST_HOT)
    met = (met.join(full, ["label", "dim", "tab", "bucket"], "left")
           .withColumn("blocks", F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)).cast("int"))
           .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("label", "dim", "tab", "bucket", F.least("block", "other").alias("i"),
                   F.greatest("block", "other").alias("j"), "block", "node", "copies", "vector", "code", "factors", "keys"))
    group = ["label", "dim", "tab", "bucket", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, turns = [], None, {}
        for batch in batches:
            head = list(zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True))
            lo = 0
            for at in range(1, len(head) + 1):
                if at == len(head) or head[at] != head[lo]:
                    if held and head[lo] != key:
                        yield links(key, held, turns)
                        held = []
                    key = head[lo]
                    held.append(batch.slice(lo, at - lo))
                    lo = at
        if held:
            yield links(key, held, turns)

    def links(key: tuple, held: list, turns: dict) -> pa.RecordBatch:
        n = sum(b.num_rows for b in held)
        if n < 2:
            return record(*(np.empty(0, np.int64),) * 3)
        part = pa.Table.from_batches(held).combine_chunks()
        col = {name: part.column(name).combine_chunks() for name in part.column_names}
        d, table = key[1], key[2]
        v = stacked(col["vector"], "f8")
        factors = stacked(col["factors"], "f4")
        r = factors.shape[1]
        if d not in turns:
            turns[d] = rotations(d, r)
        codes = np.unpackbits(stacked(col["code"], "u1"), axis=1)[:, :r * d].astype(bool)
        keys = col["keys"].flatten().to_numpy().reshape(n, -1)
        node, copies, block = (col[c].to_numpy() for c in ("node", "copies", "block"))
        left, right = np.flatnonzero(block == key[4]), np.flatnonzero(block == key[5])
        a, b = _group_links(v, keys, codes, factors, left, right, table, threshold, turns[d], key[4] == key[5])
        count = (np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)).astype(np.int64)
        low = _spanning(n, a, b)
        hit = np.flatnonzero(count)
        return record(node[hit], count[hit], node[low[hit]])

    def record(*cols: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["node", "n", "low"])

    return written(met.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "node long, n long, low long"), "counts")


def near_duplicates(rows: DataFrame, threshold: float, id_column: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    taking = F.coalesce(usable(vector), F.lit(False)) & F.col(label).isNotNull() & F.col(id_column).isNotNull()
    base = rows.select(F.col(id_column).cast("long").alias("vec_id"),
                       F.when(taking, F.col(label)).alias("label"), F.when(taking, F.col(vector)).alias("vector"))
    nodes = written(base.where("label is not null").groupBy("label", "vector")
                    .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "nodes")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    codes = codes_table(nodes, threshold, *bands(largest, threshold))
    counts = link_counts(codes, threshold)
    parts = connected_components(counts.select(F.col("node").alias("a"), F.col("low").alias("b")))
    found = (nodes.join(counts.groupBy("node").agg(F.sum("n").alias("n")), "node", "left")
             .join(parts, "node", "left")
             .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    return (base.join(found, ["label", "vector"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
