import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campaignlake.llm import periodic, queries

from .tables import DOCS, awkward_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def longest_lyndon(w):
    out = []
    for i in range(len(w)):
        ends = [j for j in range(i + 1, len(w) + 1) if all(w[i:j] < w[k:j] for k in range(i + 1, j))]
        out.append(max(ends) - i)
    return out


def brute_runs(w, least):
    """Maximal stretches per period; those whose smallest period it is."""
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        same = [w[i] == w[i + q] for i in range(n - q)] + [False]
        i = 0
        while i < len(same):
            first = i
            while same[i]:
                i += 1
            size = i - first + q if i > first else 0
            x = w[first:first + size]
            if size >= max(least, 2 * q) and not any(x[r:] == x[:-r] for r in range(1, q)):
                out.append((first, size, q))
            i += 1
    return sorted(out)


def plant(doc_id, w):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute_force(doc_id, text):
    w = plant(doc_id, WORD.findall(text or ""))
    runs = brute_runs(w, 12)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_lyndon_arrays_of_both_orders():
    rng = random.Random(1)
    for _ in range(300):
        w = [rng.randrange(1 + rng.randrange(4)) for _ in range(rng.randrange(1, 22))]
        assert periodic.lyndon_array(np.array(w)) == longest_lyndon(w)
        assert periodic.lyndon_array(np.array(w), down=True) == longest_lyndon([-x for x in w])


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return [ord(c) for c in b[:n]]


@pytest.mark.parametrize("least", [2, 12, 13])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            w = [rng.randrange(1 + rng.randrange(25)) for _ in range(rng.randrange(100))]
            if w and rng.random() < 0.6:
                s = rng.randrange(len(w))
                p = 1 + rng.randrange(max(1, (len(w) - s) // 2))
                w = [w[k] if k < s else w[s + (k - s) % p] for k in range(len(w))]
            texts.append(w)
        texts.append(fibonacci(rng.randrange(120)))
        edges = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        got = periodic.runs_in_texts(np.array(sum(texts, []), np.int64), edges, least)
        assert [tuple(r) for r in got.tolist()] == [(int(e) + s, n, q) for w, e in zip(texts, edges) for s, n, q in brute_runs(w, least)]


def test_whole_query_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    texts = ["x " * 700, "a b " * 6, "a b " * 5 + "a", "a b c " * 20 + "d " + "a b c " * 20, "\n".join(["one line here again"] * 40),
             " ".join(rng.choice("ab") for _ in range(900)), "é\x1cé\x85é " * 30, " \x0b\x0c x ", "A a " * 30]
    rows = [r for r in awkward_docs() if not r[1] or len(r[1]) < 5000]
    rows += [(1000 + i, t, "en", "s", 1) for i, t in enumerate(texts * 6)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for c in ("words", "runs", "collapsed", "g", "a", "p", "n", "best", "start"):
        docs = docs.withColumn(c, F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op12_runs(spark, str(tmp_path)).collect()), key=str)
    want = sorted((brute_force(r[0], r[1]) for r in rows), key=str)
    assert got == want
    assert sum(r[1] > 0 and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in got if r[0]) > 3  # planted ones among them


def test_long_text_and_slices(monkeypatch):
    text = "the quick brown " * 60_000 + "end"  # one run in a text of 180,001 words
    monkeypatch.setattr(periodic, "SLICE_BYTES", 10)
    column = pa.array([text, None, "a b", text])
    assert list(periodic.slices(column, 10)) == [(0, 1), (1, 2), (3, 1)]
    n, runs, collapsed = periodic.treat(column, 12)
    assert n.to_pylist() == [180_001, 0, 2, 180_001]
    assert runs.to_pylist()[0] == [{"start": 0, "length": 180_000, "period": 3}] and runs.to_pylist()[1] == []
    assert collapsed.to_pylist() == ["the quick brown end", "", "a b", "the quick brown end"]


def test_empty_table(spark):
    assert periodic.find(spark.createDataFrame([], DOCS)).count() == 0
