"""Periodic runs of words in every text.

A run is a maximal stretch with smallest period q and length >= max(least, 2q).
Every run is the extension of a Lyndon root: for one of two opposite orders of
the words, the longest Lyndon factor at some place of the run has length q
(Bannai et al., 2017).  The Lyndon arrays of both orders come from the first
phase of Baier's suffix sorter: groups of suffixes with the same Lyndon prefix
are taken from the highest down; every suffix of a group lengthens the prefix
of the last place before it whose group is still to come, and places lengthened
alike leave their group together for a new one right above it.  When a group is
taken, its prefix is the Lyndon factor of its places; no suffix is sorted.

Each place and its factor are then extended to both sides by longest common
extensions (ranks of the stretches of 1, 2, 4 ... words, exact) and kept when
they make a run.

Sorting is spared where no run can be: a run is at least ``least`` words long
and at most half of it is one period, so every window of ``least // 2`` words
inside occurs again in the same text, and each of its places lies in such a
window.  Stretches of places covered by repeated windows are treated; a run
lies in one of them whole, and its neighbours outside do not continue it.

Work is linear in the words but for the ranks (a factor of the logarithm of the
longest stretch).  A task holds a slice of a batch: whole texts, about
``SLICE_BYTES`` together or one text; beside the text itself that is up to some
200 bytes a word.

Defined cases: null text has no words (empty array, empty collapsed text); words
are runs of anything but blank and control characters 9 to 13, compared as
bytes; runs may overlap and nest; rows are treated one by one, so repeated rows
give repeated rows; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

LEAST = 12
SLICE_BYTES = 8 << 20


def lyndon_array(words: np.ndarray, down: bool = False) -> list[int]:
    """Length of the longest Lyndon factor at every place, by the groups of
    Baier's first phase.  ``words``: integers; ``down`` reverses their order."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    members = [g.tolist() for g in np.split(order, np.flatnonzero(np.diff(words[order])) + 1)]
    if down:
        members.reverse()
    group = [0] * n
    for k, g in enumerate(members):
        for i in g:
            group[i] = k
    live = list(map(len, members))  # members that have not moved on
    # groups in their order, as a linked list
    lower, upper = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    # places whose group is still to come, as a linked list; entry n, also reached as -1, ends both sides
    left, right = list(range(-1, n)), [*range(1, n + 1), 0]
    length = [1] * n
    g = len(members) - 1
    while g >= 0:
        own = members[g]
        if live[g] < len(own):
            own = [i for i in own if group[i] == g]
        times: dict[int, int] = {}
        for i in own:
            before, after = left[i], right[i]
            left[after], right[before] = before, after
            if before >= 0:
                times[before] = times.get(before, 0) + 1
        size = length[own[0]]
        moves: dict[tuple[int, int], list[int]] = {}
        for i, k in times.items():
            length[i] += k * size
            moves.setdefault((k, group[i]), []).append(i)
        # from each group those lengthened most stand highest
        for k, h in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            places = moves[k, h]
            if len(places) < live[h]:
                new = len(members)
                live[h] -= len(places)
                for i in places:
                    group[i] = new
                members.append(places)
                live.append(len(places))
                lower.append(h)
                upper.append(upper[h])
                lower[upper[h]] = new
                upper[h] = new
        g = lower[g]
    return length


def stretch_ranks(words: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Entry k: for every place, a number of the 2^k words from there (equal
    for equal stretches; -1 where the segment, which ends before ``end``, is
    shorter).  Stops where no stretch occurs twice."""
    out, step, room = [], 1, end - np.arange(len(words))
    now = pd.factorize(words)[0].astype(np.int64)
    while True:
        out.append(now.astype(np.int32))
        at = np.flatnonzero(room >= 2 * step)
        if not len(at):
            return out
        codes, distinct = pd.factorize(now[at] * len(words) + now[at + step])
        if len(distinct) == len(codes):
            return out
        now = np.full(len(words), -1, np.int64)
        now[at] = codes
        step *= 2


def _extended(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, limit: np.ndarray, ahead: bool) -> np.ndarray:
    """How many words agree from i and j on (or, not ``ahead``, before them), at most ``limit``."""
    found = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        step = 1 << k
        at = np.flatnonzero(found + step <= limit)
        by = found[at] if ahead else -found[at] - step
        found[at[ranks[k][i[at] + by] == ranks[k][j[at] + by]]] += step
    return found


def runs_of(words: np.ndarray, edges: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, length, period), sorted, of the runs inside the segments of
    ``words`` between neighbouring ``edges``."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    sizes = np.diff(edges)
    begin, end = np.repeat(edges[:-1], sizes), np.repeat(edges[1:], sizes)
    ranks, here = stretch_ranks(words, end), np.arange(len(words))
    found = []
    for down in (False, True):
        period = np.concatenate([np.array(lyndon_array(words[a:b], down), np.int64) for a, b in zip(edges[:-1], edges[1:], strict=True)])
        there = here + period
        ahead = _extended(ranks, here, np.minimum(there, end - 1), end - there, True)
        back = _extended(ranks, here, there, here - begin, False)
        length = back + period + ahead
        keep = length >= np.maximum(least, 2 * period)
        found.append(np.stack([(here - back)[keep], length[keep], period[keep]], 1))
    return np.unique(np.concatenate(found), axis=0)


def repeated_stretches(words: np.ndarray, edges: np.ndarray, least: int) -> np.ndarray:
    """Rows (begin, end): stretches of at least ``least`` places covered by
    windows of ``least // 2`` words that occur twice in the same text.  (Equal
    hashes of different windows only make a stretch longer.)"""
    width, n = max(1, least // 2), len(words)
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    at = np.flatnonzero(edges[1:][text] - np.arange(n) >= width) if n else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros((0, 2), np.int64)
    key = text[at].astype(np.uint64)
    for k in range(width):
        key = (key ^ words[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    again = at[pd.Index(key).duplicated(keep=False)]
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, again, 1)
    np.add.at(depth, again + width, -1)
    covered = np.cumsum(depth) > 0  # one place more than words, never covered
    opens, before = covered.copy(), np.concatenate([[False], covered[:-1]])
    first = np.zeros(n + 1, bool)
    first[edges] = True
    opens &= ~before | first
    closes = before & (~covered | first)
    out = np.stack([np.flatnonzero(opens), np.flatnonzero(closes)], 1)
    return out[out[:, 1] - out[:, 0] >= least]


def runs_in_texts(words: np.ndarray, edges: np.ndarray, least: int = LEAST) -> np.ndarray:
    """As ``runs_of`` for whole texts, which lie between neighbouring ``edges``."""
    stretches = repeated_stretches(words, edges, least)
    if not len(stretches):
        return np.zeros((0, 3), np.int64)
    sizes = stretches[:, 1] - stretches[:, 0]
    inside = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(inside[-1]) + np.repeat(stretches[:, 0] - inside[:-1], sizes)
    runs = runs_of(words[places], inside, least)
    runs[:, 0] = places[runs[:, 0]]
    return runs


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts``, and where each text's words begin (and the last ones end)."""
    split = pc.ascii_split_whitespace(texts)
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    some = pc.not_equal(flat, "")  # blanks at the edges of a text leave empty words
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return flat.filter(some), before[offsets - offsets[0]]


def treat(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """For each text the number of words, its runs and the collapsed text."""
    flat, edges = _words(pc.fill_null(texts, ""))
    words = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = runs_in_texts(words, edges, least)
    text = np.searchsorted(edges, runs[:, 0], "right") - 1
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(text, np.arange(len(edges))).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(runs[:, 0] - edges[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                                   ["start", "length", "period"]))
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(depth)[:-1] == 0
    places = np.concatenate([[0], np.cumsum(kept)])[edges]
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), flat.filter(pa.array(kept))), " ")
    return pa.array(np.diff(edges)), lists, joined


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first, number) of neighbouring texts with ``most`` bytes together, or one text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(size):
        done = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, done + most, "right")))
        yield first, last - first
        first = last


def find(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, ``runs`` (array of start, length, period in words, by
    start, length and period) and ``collapsed``: the text's words joined by one blank,
    without those that a run holds after its first period."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(1), SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *treat(batch.column(1).slice(first, n), least)],
                                                 ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
