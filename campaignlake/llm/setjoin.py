"""Jaccard self-join of documents as sets of word n-grams, size-aware.

Small sets enumerate fixed-size subsets: for every size o that the overlap with
a partner may need, all subsets of o elements are keys, so two small sets that
share o elements meet at a key.  Large sets scan inverted lists.  Sizes lie in
brackets, and a bracket deals the elements to parts by hash; what a set has in
a part is a token.  Two sets that differ in d elements differ in d tokens at
most, so with one global order of tokens, rare ones first, each posts its first
d + 1, d being the most that a partner in the bracket may differ in, and two
sets at similarity t or more share one of them.  A token stands for several
elements, so lists hold sets that agree in all of these and stay short however
large the corpus is; a set with fewer tokens posts them all, and its first
a - ceil(t * a) + 1 elements for others of its kind.  The boundary between small
and large is where the sum of keys and list entries is least (``boundary``);
sets within a factor t of it are in both parts, so no pair falls between.

The order comes from a count sketch with a bucket for every ``LOAD`` shingles,
up to 16 MB: a token is as rare as its rarest element.  It only says how long
lists are: any order gives the same links.

A task ties the sets that meet at a key to one of them and hands on only that
one, and keys move in blocks of a range of keys each, where the rest is tied.
Sets that are tied form candidate groups; each group's texts are brought
together once (large groups as pairs of blocks of bounded size), where the
overlaps are counted exactly and the links are reduced to a spanning forest.
Copies (equal sets) are one node throughout.  No list, group or set is capped.

Defined cases: null text or text without words has an empty set and links with
nothing; fewer than n words are one element; repeated rows are copies of one
another; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, mix64, written

LOAD = 4                # shingles to a bucket of the sketch, up to the size below
LEAST_BITS, MOST_BITS = 16, 24  # of the sketch: 64 KB to 16 MB
CHUNK_BITS = 16         # of the sketch, in one row
WORD_BYTES = 6          # for the size of the sketch
MOST_SMALL = 24         # largest boundary that is considered
BLOCK_SHINGLES = 2_000_000
SPREAD = 1.5            # parts of a bracket for each token that a set posts
LONG_LIST = 1_000_000   # keys that a task gathers before it ties them
RANGE_KEYS = 1_000_000  # of a range of keys, about
LEAST_RANGES = 48
ID_BITS = 27            # of the filter of ids: 16 MB
ID_CHUNK = 1 << 17      # bytes
ID_PARTS = 8
CACHED_WORDS = 150_000
HELD_SHINGLES = 500_000  # that a task gathers before it adds them to its sketch
_P = np.uint64(0x9E3779B97F4A7C15)
_SALTS = tuple(map(np.uint64, (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03, 0xDB4F0B9175AE2165,
                              0xBBE0563303A4615F)))


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept for at most ``CACHED_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = h
        return h


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def shingles(text: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of lower-cased words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, np.uint64(k))
    for i in range(k):
        h = h * _P + w[i:len(w) - k + 1 + i]
    return np.unique(mix64(h))


def signature(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, independent of order."""
    return tuple(int(mix64(mix64(s ^ salt).sum(keepdims=True))[0].astype(np.int64)) for salt in _SALTS[:2])


def need(a: int, b: int, num: int, den: int) -> int:
    """Least overlap of sets of a and b elements at similarity num/den."""
    return -(-num * (a + b) // (den + num))


def subset_sizes(a: int, num: int, den: int) -> list[int]:
    """Overlaps that a set of ``a`` may need with partners of any size."""
    return sorted({need(a, b, num, den) for b in range(-(-num * a // den), den * a // num + 1)})


def prefix(a: int, num: int, den: int) -> int:
    return a - -(-num * a // den) + 1


def subset_keys(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of all subsets of ``s`` that have a size in ``subset_sizes``."""
    h = mix64(s ^ _SALTS[2])
    total, out = h.sum(), []
    for o in subset_sizes(len(s), num, den):
        dropped = np.array([sum(map(int, c)) & (1 << 64) - 1 for c in combinations(h, len(s) - o)], np.uint64)
        out.append(mix64(total - dropped + np.uint64(o * int(_P) & (1 << 64) - 1)))
    return np.concatenate(out)


def bracket_lows(num: int, den: int) -> np.ndarray:
    """Least sizes of the brackets, a factor of t * t apart."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, -(-lows[-1] * den * den // (num * num))))
    return np.array(lows, np.int64)


def most_apart(a: int, b: int, num: int, den: int) -> int:
    """Most elements in one of two sets of a and b only, at similarity num/den."""
    return (a + b) * (den - num) // (den + num)


def list_keys(s: np.ndarray, level: np.ndarray, lows: np.ndarray, num: int, den: int) -> list[np.ndarray]:
    """Keys of the lists that a set is in, for its bracket and, if it may link
    with larger sets there, the next one.  ``level``: of its elements, by the
    sketch."""
    a, out = len(s), []
    at = int(np.searchsorted(lows, a, "right")) - 1
    place = mix64(s ^ _SALTS[3])
    order = np.argsort(place)
    place, value, level_at = place[order] >> np.uint64(32), mix64(s ^ _SALTS[4])[order], level[order]
    for i in (at, at + 1):
        if a * den < num * int(lows[i]):
            continue
        top = int(lows[i + 1]) - 1
        parts = int(np.ceil(SPREAD * (most_apart(top, top, num, den) + 1)))
        d = most_apart(a, min(top, a * den // num), num, den)
        part = place * np.uint64(parts) >> np.uint64(32)  # in order, as places are
        starts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        salt = np.uint64((i + 1) * int(_P) & (1 << 64) - 1)
        tokens = mix64(mix64(np.add.reduceat(value, starts) + part[starts]) ^ salt)
        if len(tokens) > d + 1:
            rank = np.minimum.reduceat(level_at, starts).astype(np.uint64) << np.uint64(56) | tokens >> np.uint64(8)
            tokens = tokens[np.argpartition(rank, d)[:d + 1]]
        out.append(tokens)
        if len(tokens) <= d:
            # rare first, equal levels by hash (s is sorted, the sort is stable)
            out.append(mix64(s[np.argsort(level, kind="stable")[:prefix(a, num, den)]] ^ salt))
    return out


def tied(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest node at each, and the distinct pairs
    (rows) of it and another node there."""
    order = np.argsort(keys)
    keys, nodes = keys[order], nodes[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)]
    starts = np.flatnonzero(first)
    if not len(starts):
        return keys, nodes, np.empty((0, 2), np.int64)
    low = np.minimum.reduceat(nodes, starts)
    each = np.repeat(low, np.diff(np.append(starts, len(keys))))
    more = each != nodes
    return keys[starts], low, distinct_pairs(np.stack([each[more], nodes[more]], axis=1))


def distinct_pairs(pairs: np.ndarray) -> np.ndarray:
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])[:len(pairs)]]


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def boundary(sizes: dict[int, int], counts: np.ndarray, num: int, den: int) -> int:
    """Largest size that enumerates subsets.  ``sizes``: sets by size up to
    ``MOST_SMALL`` + a factor; ``counts``: buckets of the sketch by level.  A
    set's list entries are estimated as its prefix length times the mean count
    in the rare part of the elements that the prefix takes."""
    levels = sketch_value(np.arange(256))
    mass = counts * levels
    share = np.cumsum(mass) / max(1.0, mass.sum())

    def scan(a: int) -> float:
        p = prefix(a, num, den)
        upto = int(np.searchsorted(share, p / a)) + 1
        return p * (1 + (mass[:upto] * levels[:upto]).sum() / max(1.0, mass[:upto].sum()))

    def cost(x: int) -> float:
        small = sum(m * sum(comb(a, o) for o in subset_sizes(a, num, den)) for a, m in sizes.items() if a <= x)
        return small + sum(m * scan(a) for a, m in sizes.items() if a * den >= num * (x + 1))

    return min(range(MOST_SMALL + 1), key=cost)


def sketch_level(c: np.ndarray) -> np.ndarray:
    """Counts as 8 bits: exact up to 64, then 16 steps for a doubling."""
    high = 64 + 16 * np.log2(np.maximum(c, 64) / 64)
    return np.minimum(255, np.where(c <= 64, c, high)).astype(np.uint8)


def sketch_value(level: np.ndarray) -> np.ndarray:
    return np.where(level <= 64, level, 64 * 2 ** ((level - 64.0) / 16))


def _packed_counts(counts: np.ndarray) -> bytes:
    """A chunk of small counts: a bit for each bucket in use, then places and
    counts of those above one."""
    many = np.flatnonzero(counts > 1)
    return np.packbits(counts > 0).tobytes() + many.astype("<u2").tobytes() + counts[many].tobytes()


def _unpacked_counts(raw: bytes) -> np.ndarray:
    size = (1 << CHUNK_BITS) // 8
    out = np.unpackbits(np.frombuffer(raw[:size], np.uint8))
    many = (len(raw) - size) // 3
    out[np.frombuffer(raw[size:size + 2 * many], "<u2")] = np.frombuffer(raw[size + 2 * many:], np.uint8)
    return out


def sketch_bits(docs: DataFrame) -> int:
    """log2 of the sketch's buckets for this corpus."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(min(MOST_BITS, max(LEAST_BITS, round(np.log2(max(1.0, total / WORD_BYTES / LOAD))))))


def _first_pass(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """Written rows of (doc_id, n_shingles, s1, s2) for documents, and of
    (chunk, counts) for the sketch of each task."""
    size, shift = 1 << CHUNK_BITS, np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, n_held = WordHashes(), [], 0
        counts = np.zeros(1 << bits, np.uint8)

        def add() -> None:
            at, c = np.unique(np.concatenate(held), return_counts=True)
            counts[at] = np.minimum(255, counts[at] + c)
            held.clear()

        for batch in batches:
            rows = []
            for text in batch.column(1):
                s = shingles(as_bytes(text.as_py()), n, hashes)
                rows.append((len(s), *signature(s)))
                held.append((s >> shift).astype(np.uint32))
                n_held += len(s)
                if n_held > HELD_SHINGLES:
                    add()
                    n_held = 0
            a = np.array(rows, np.int64).reshape(-1, 3)
            m = len(a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(a[:, i].copy()) for i in range(3)), pa.nulls(m, pa.int32()),
                 pa.nulls(m, pa.binary())], names)
        if held:
            add()
        pack = zstandard.ZstdCompressor(level=1)
        for at in range(0, 1 << bits, 64 * size):
            parts = counts[at:at + 64 * size].reshape(-1, size)
            used = np.flatnonzero(parts.any(axis=1))
            if len(used):
                m = len(used)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, kind_arrow), *(pa.nulls(m, pa.int64()) for _ in range(3)),
                     pa.array(used + at // size, pa.int32()),
                     pa.array([pack.compress(_packed_counts(parts[i])) for i in used], pa.binary())], names)

    names = ["doc_id", "n_shingles", "s1", "s2", "chunk", "counts"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    kind_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    out = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, chunk int, counts binary")
    return written(out, "sets")


def _sketch(first: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The tasks' sketches summed by chunk (64 MB at most reach the driver),
    and the number of buckets by level."""
    size = 1 << CHUNK_BITS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # partial sums in place, chunk by chunk (rows are sorted by chunk)
        unpack, chunk, total = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for c, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if c != chunk:
                    if total is not None:
                        yield row(chunk, total)
                    chunk, total = c, np.zeros(size, np.uint32)
                total += _unpacked_counts(unpack.decompress(raw.as_py()))
        if total is not None:
            yield row(chunk, total)

    def row(chunk: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()),
                                           pa.array([sketch_level(total).tobytes()], pa.binary())], ["chunk", "levels"])

    parts = (first.where("chunk is not null").select("chunk", "counts").repartition("chunk")
             .sortWithinPartitions("chunk").mapInArrow(add, "chunk int, levels binary"))
    out, seen = np.zeros(1 << bits, np.uint8), np.zeros(256)
    for r in parts.toLocalIterator():
        part = np.frombuffer(r["levels"], np.uint8)
        out[r["chunk"] * size:(r["chunk"] + 1) * size] = part
        seen += np.bincount(part, minlength=256)
    return out, seen


def _postings(docs: DataFrame, n: int, num: int, den: int, sketch: np.ndarray, bits: int, small: int, ranges: int) -> DataFrame:
    """(range, kind, data): by range of keys, blocks of keys and a node for each
    (kind 0), and by range of first nodes, blocks of candidate edges (kind 1).
    A node is a set's first signature.  Equal sets of a task are taken once, and
    a key of several sets leaves a task once, with edges between these sets."""
    shared, shift, lows = docs.sparkSession.sparkContext.broadcast(sketch), np.uint64(64 - bits), bracket_lows(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, levels, seen = WordHashes(), shared.value, set()
        keys, nodes, lens, held = [], [], [], 0
        for batch in batches:
            for text in batch.column(0):
                s = shingles(as_bytes(text.as_py()), n, hashes)
                a = len(s)
                if not a or (node := signature(s)[0]) in seen:
                    continue
                seen.add(node)
                found = [subset_keys(s, num, den)] if a <= small else []
                if a * den >= num * (small + 1):
                    found += list_keys(s, levels[s >> shift], lows, num, den)
                keys += found
                nodes.append(node)
                lens.append(sum(map(len, found)))
                held += lens[-1]
                if held >= LONG_LIST:
                    yield emit(keys, nodes, lens)
                    keys, nodes, lens, held = [], [], [], 0
        if nodes:
            yield emit(keys, nodes, lens)

    def emit(keys: list, nodes: list, lens: list) -> pa.RecordBatch:
        at, low, edges = tied(np.concatenate(keys), np.repeat(np.array(nodes, np.int64), lens))
        rows = [(r, 0, at[lo:hi].tobytes() + low[lo:hi].tobytes()) for r, lo, hi in blocks(range_of(at, ranges))]
        where = range_of(mix64(edges[:, 0].view(np.uint64) if len(edges) else np.empty(0, np.uint64)), ranges)
        order = np.argsort(where, kind="stable")
        rows += [(r, 1, edges[order[lo:hi]].tobytes()) for r, lo, hi in blocks(where[order])]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.int32()),
             pa.array([x[2] for x in rows], pa.binary())], ["range", "kind", "data"])

    def blocks(where: np.ndarray) -> list[tuple[int, int, int]]:
        ends = np.append(np.flatnonzero(where[1:] != where[:-1]) + 1, len(where)).tolist() if len(where) else []
        return [(int(where[lo]), lo, hi) for lo, hi in zip([0, *ends], ends, strict=False)]

    return docs.select("text").mapInArrow(run, "range int, kind int, data binary")


def _stars(posts: DataFrame) -> DataFrame:
    """Candidate edges (a, b): at every key, the sets are tied to the smallest
    of them, so an edge a posting at most.  A task holds one range of keys at a
    time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [])
        for batch in batches:
            for r, kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if r != now:
                    if now is not None:
                        yield emit(*held)
                    now, held = r, ([], [])
                held[kind].append(data.as_py())
        if now is not None:
            yield emit(*held)

    def emit(posted: list, edges: list) -> pa.RecordBatch:
        halves = [np.frombuffer(x, np.int64).reshape(2, -1) for x in posted]
        keys, nodes = np.concatenate([np.empty((2, 0), np.int64), *halves], axis=1)
        found = [tied(keys.view(np.uint64), nodes)[2], *(np.frombuffer(x, np.int64).reshape(-1, 2) for x in edges)]
        pairs = distinct_pairs(np.concatenate(found))
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, i].copy(), pa.int64()) for i in (0, 1)], ["a", "b"])

    return posts.repartition("range").sortWithinPartitions("range").mapInArrow(run, "a long, b long")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, text, packed) of ``docs`` that may be among ``wanted``.doc_id: a
    bit for each hash of an id, 16 MB whatever the input, drops the others
    before they are shuffled.  (An exact join follows.)"""
    def place(ids: np.ndarray) -> np.ndarray:
        return (mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - ID_BITS)).astype(np.int64)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((1 << ID_BITS) // 8, np.uint8)
        for batch in batches:
            at = place(batch.column(0).to_numpy())
            np.bitwise_or.at(bits, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        for lo in range(0, len(bits), ID_CHUNK):
            part = bits[lo:lo + ID_CHUNK]
            if part.any():
                raw = zstandard.ZstdCompressor(level=1).compress(part.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([raw], pa.binary())], ["lo", "bits"])

    filled = np.zeros((1 << ID_BITS) // 8, np.uint8)
    for r in wanted.select("doc_id").coalesce(ID_PARTS).mapInArrow(mark, "lo long, bits binary").toLocalIterator():
        part = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["bits"]), np.uint8)
        filled[r["lo"]:r["lo"] + len(part)] |= part
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            at = place(batch.column(0).to_numpy())
            hit = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            packed = [pack.compress(as_bytes(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(keep, "doc_id long, text binary")


def forest(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among ``sets``: breadth first, counting a
    set's overlaps with all sets not yet reached through inverted lists."""
    k = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    _, inv = np.unique(np.concatenate(sets), return_inverse=True)
    inv = inv.reshape(-1)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(k), sizes)
    left = np.ones(k, bool)

    def lists() -> tuple[np.ndarray, np.ndarray]:
        alive = left[owner]
        order = np.argsort(inv[alive], kind="stable")
        counts = np.bincount(inv[alive], minlength=inv.max() + 1)
        return owner[alive][order], np.concatenate([[0], np.cumsum(counts)])

    members, ptr = lists()
    listed, edges = k, []
    for seed in range(k):
        if not left[seed]:
            continue
        left[seed] = False
        queue = [seed]
        while queue:
            d = queue.pop()
            alive = int(left.sum())
            if not alive:
                return edges
            if 2 * alive <= listed and listed > 16:
                members, ptr = lists()
                listed = alive
            e = inv[ends[d]:ends[d + 1]]
            lens = ptr[e + 1] - ptr[e]
            at = np.repeat(ptr[e] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
            c = np.bincount(members[at], minlength=k)
            hit = np.flatnonzero(left & (den * c >= num * (sizes[d] + sizes - c)))
            left[hit] = False
            edges += [(d, int(h)) for h in hit]
            queue += hit.tolist()
    return edges


def _verify(rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links (a, b) within each (component, i, j) of ``rows``, which also has
    doc_id, s1 and the packed text.  Rows stream by group; one group is held at
    a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpack, key, ids, sets = WordHashes(), zstandard.ZstdDecompressor(), None, [], []
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in range(5)]
            for c, i, j, doc, s1, text in zip(*cols, batch.column(5), strict=True):
                if (c, i, j) != key:
                    out += links(ids, sets)
                    key, ids, sets = (c, i, j), [], []
                s = shingles(unpack.decompress(text.as_py()), n, hashes)
                if signature(s)[0] == s1:  # an id may stand for several texts
                    ids.append(doc)
                    sets.append(s)
            yield record(out)
        yield record(links(ids, sets))

    def links(ids: list, sets: list) -> Iterable[tuple]:
        return [(ids[a], ids[b]) for a, b in forest(sets, num, den)] if len(ids) > 1 else []

    def record(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return (rows.select("component", "i", "j", "doc_id", "s1", "text").repartition("component", "i", "j")
            .sortWithinPartitions("component", "i", "j").mapInArrow(run, "a long, b long"))


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (long
    doc_id, text): documents link at Jaccard similarity num/den or more of their
    sets of ``n``-word shingles; component_id is the smallest doc_id that links
    reach."""
    bits = sketch_bits(docs)
    first = _first_pass(docs, n, bits)
    sets = first.where("chunk is null").select("doc_id", "n_shingles", "s1", "s2")
    sketch, levels = _sketch(first, bits)
    sizes = dict(sets.where(F.col("n_shingles").between(1, 2 * MOST_SMALL)).groupBy("n_shingles").count().collect())
    small = boundary(sizes, levels, num, den)
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = int(max(LEAST_RANGES, -(-total * 3 * (den - num) // (2 * num * RANGE_KEYS))))
    groups = connected_components(_stars(_postings(docs, n, num, den, sketch, bits, small, ranges)))

    classes = written(sets.where("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2", "n_shingles")
                      .agg(F.min("doc_id").alias("first_id")), "classes")
    members = classes.join(groups, F.col("s1") == F.col("node")).select("first_id", "s1", "n_shingles", "component")
    blocks = members.groupBy("component").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("n_blocks"))
    placed = members.join(blocks, "component").withColumn(
        "block", F.pmod(F.xxhash64("first_id"), F.col("n_blocks")).cast("int"))
    other = F.when(F.col("n_blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda x: x != F.col("block")))
    placed = (placed.withColumn("other", F.explode(other))
              .select(F.col("first_id").alias("doc_id"), "s1", "component",
                      F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    placed = written(placed, "placed")
    links = written(_verify(placed.join(_texts_of(docs, placed), "doc_id"), n, num, den), "pairs")
    found = connected_components(links)
    ends = (classes.join(found, F.col("first_id") == F.col("node"), "left")
            .select("s1", "s2", "n_shingles", F.coalesce("component", "first_id").alias("found")))
    return (sets.join(ends, ["s1", "s2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with
    the smallest id.  Rows of one id are one document; a null id is no
    document and goes."""
    first = (jaccard_components(docs, n, num, den).where("doc_id = component_id").select(F.col("doc_id").alias("__first_id")).distinct())
    return (docs.join(first, docs["doc_id"] == first["__first_id"], "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns))
