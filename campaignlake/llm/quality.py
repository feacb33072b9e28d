"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a table of scores by bin.  The tables are learnt by cyclic
boosting: in turn, each feature gets a shallow tree over its own bins that fits
the gradient of the log loss, added with a small rate.  Then the pairs that
lower the loss of what is left most get tables of their own, again boosted in
turn.  A score is a sum of table entries, so that scoring is a few vectorised
look-ups per feature.

The model is fitted on a bounded sample of labelled rows (``SAMPLE``, by a hash
of the id); features are computed from whole texts.  Defined cases: null text
is empty; empty texts have features like any other; without a labelled row of
both kinds every score is the share of label 1 (0.5 without any); repeated rows
score alike; labels of one id that disagree are learnt from one by one; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash, written

SAMPLE = 30_000   # labelled rows
BINS = 32
COARSE = 8        # bins of a pair's sides
ROUNDS = 250
PAIR_ROUNDS = 100
PAIRS = 12
RATE = 0.08
LEAVES = 4

NAMES = ("log_words", "log_chars", "word_length", "word_length_spread", "upper", "letters", "digits", "marks", "spaces",
         "non_ascii", "marks_per_word", "odd_marks", "distinct_words", "top_word", "same_as_last", "repeated_bigrams",
         "repeated_lines", "line_words", "short_words", "bars", "compression", "longest_run", "sentence_words",
         "capital_words")
_RUN = re.compile(r"(.)\1{2,}", re.S)

# classes of bytes: upper, lower, digit, white space, other printable mark, beyond ASCII
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[128:] = 5


def features(text: str | None) -> list[float]:
    """The values of ``NAMES`` for a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    b = np.frombuffer(raw, np.uint8)
    by = np.bincount(b, minlength=256)
    kinds = np.bincount(_CLASS, by, 6)
    n = max(1, len(b))
    words = text.split()
    m = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    ids = np.fromiter(map({w: i for i, w in enumerate(counts)}.__getitem__, words), np.int64, len(words))
    pairs = ids[1:] * max(1, len(counts)) + ids[:-1]
    lines = [x for x in text.split("\n") if x]
    usual = by[[44, 46, 39, 45]].sum()  # comma, full stop, apostrophe, hyphen
    marks = kinds[0]
    squeezed = len(zlib.compress(raw, 1)) if raw else 0
    longest = max((x.end() - x.start() for x in _RUN.finditer(text)), default=0)
    return [np.log1p(len(words)), np.log1p(len(text)), sizes.mean(), sizes.std(), kinds[1] / n, (kinds[1] + kinds[2]) / n,
            kinds[3] / n, marks / n, kinds[4] / n, kinds[5] / n, marks / m, (marks - usual) / m, len(counts) / m,
            (max(counts.values()) if counts else 0) / m, float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0,
            1 - len(np.unique(pairs)) / max(1, len(pairs)) if len(pairs) else 0.0,
            1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0, m / max(1, len(lines)),
            float((sizes <= 3).mean()), by[124] / m, squeezed / n, np.log1p(longest), m / max(1, int(by[[33, 46, 63]].sum())),
            sum(map(str.istitle, words)) / m]


@dataclass
class Gam:
    base: float
    edges: list[np.ndarray]             # of each feature's bins
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]       # flat, COARSE x COARSE

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for the rows of ``x``."""
        bins = binned(x, self.edges)
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[bins[:, j]]
        low = coarse(bins, self.edges)
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[low[:, i] * COARSE + low[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], 1)


def coarse(bins: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([bins[:, j] * COARSE // (len(e) + 1) for j, e in enumerate(edges)], 1)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float = 4.0, ridge: float = 1.0) -> np.ndarray:
    """Steps of a tree over ordered bins with gradient and curvature sums: the
    best cuts one after another, up to ``leaves`` pieces."""
    cuts, best = [0, len(g)], [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(best) < leaves:
        gain, where = 1e-9, None
        for lo, hi in best:
            if hi - lo < 2:
                continue
            k = np.arange(lo + 1, hi)
            gl, hl = cg[k] - cg[lo], ch[k] - ch[lo]
            gr, hr = cg[hi] - cg[k], ch[hi] - ch[k]
            s = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - (cg[hi] - cg[lo]) ** 2 / (ch[hi] - ch[lo] + ridge)
            s[(hl < least / 4) | (hr < least / 4)] = 0
            if s.max() > gain:
                gain, where = s.max(), int(k[s.argmax()])
        if where is None:
            break
        cuts = sorted({*cuts, where})
        best = list(zip(cuts, cuts[1:]))
    out = np.zeros(len(g))
    for lo, hi in best:
        out[lo:hi] = (cg[hi] - cg[lo]) / (ch[hi] - ch[lo] + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Steps and gain of a tree over a grid: one cut of the first side, then a
    cut of the second side in each part (or the other way round)."""
    def one(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        best = (np.zeros_like(g), 0.0)
        for k in range(1, len(g)):
            steps = np.zeros_like(g)
            gain = 0.0
            for part in (slice(0, k), slice(k, len(g))):
                gs, hs = g[part].sum(axis=0), h[part].sum(axis=0)
                t = _tree(gs, hs, 2)
                steps[part] = t
                gain += float((2 * gs * t - hs * t * t).sum())
            if gain > best[1]:
                best = steps, gain
        return best

    a, b = one(g, h), one(g.T, h.T)
    return a if a[1] >= b[1] else (b[0].T, b[1])


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """The model of features ``x`` and labels ``y`` (0 or 1)."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / np.clip(1 - share, 1e-3, 1)))
    width = x.shape[1]
    if len(y) < 2 or share in (0.0, 1.0):
        return Gam(base, [np.empty(0)] * width, [np.zeros(1)] * width, [], [])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    bins = binned(x, edges)
    tables = [np.zeros(len(e) + 1) for e in edges]
    z = np.full(len(y), base)
    for _ in range(ROUNDS):
        for j in range(width):
            p = 1 / (1 + np.exp(-z))
            n = len(tables[j])
            step = RATE * _tree(np.bincount(bins[:, j], y - p, n), np.bincount(bins[:, j], p * (1 - p), n), LEAVES)
            tables[j] += step
            z += step[bins[:, j]]
    low = coarse(bins, edges)
    p = 1 / (1 + np.exp(-z))

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(low[:, i] * COARSE + low[:, j], v, COARSE * COARSE).reshape(COARSE, COARSE)

    ranked = sorted(((-_pair_tree(grid(i, j, y - p), grid(i, j, p * (1 - p)))[1], i, j)
                     for i in range(width) for j in range(i)))
    pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain < 0]
    pair_tables = [np.zeros(COARSE * COARSE) for _ in pairs]
    for _ in range(PAIR_ROUNDS if pairs else 0):
        for k, (i, j) in enumerate(pairs):
            p = 1 / (1 + np.exp(-z))
            step = RATE * _pair_tree(grid(i, j, y - p), grid(i, j, p * (1 - p)))[0].reshape(-1)
            pair_tables[k] += step
            z += step[low[:, i] * COARSE + low[:, j]]
    return Gam(base, edges, tables, pairs, pair_tables)


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every row, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)], np.float64).reshape(-1, len(NAMES))
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, pa.array(x.reshape(-1)))],
                                             ["doc_id", "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, features array<double>"), "features")


def classify(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality") -> DataFrame:
    """(doc_id, score) of every row of ``docs``.  Labels come from rows of
    ``labels`` for which ``usable`` holds."""
    table = feature_table(docs)
    known = labels.where(usable & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y"))
    rows = first_by_hash(table.join(known, "doc_id"), SAMPLE, ties=("y",)).select("features", "y").toPandas()
    x = np.stack(rows["features"]) if len(rows) else np.zeros((0, len(NAMES)))
    model = fit(x, rows["y"].to_numpy(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return table.mapInArrow(run, f"doc_id {kind}, score double")
