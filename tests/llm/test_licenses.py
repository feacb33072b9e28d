import math
import random
import re

import pytest
from pyspark.sql import functions as F

from campaignlake.llm import licenses, queries

from .tables import DOCS, awkward_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def brute_force(rows):
    """Every window of both grids, every place of every phrase."""
    texts = [words(r[1]) for r in rows]
    seen = {}
    for w in texts:
        for x in set(w):
            seen[x] = seen.get(x, 0) + 1
    out, slack = [], licenses.SLACK
    for (doc_id, *_), w in zip(rows, texts):
        places = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
        shares = {}
        for label, text, keys in licenses.TEMPLATES:
            t = words(text)
            rare = sorted(set(t), key=lambda x: (seen.get(x, 0), x))[:licenses.RARE]
            begins = [(i - at, x) for i, x in enumerate(w) if x in rare for at, y in enumerate(t) if x == y]
            for shift in (0, slack):
                windows = {}
                for begin, x in begins:
                    windows.setdefault((begin + shift) // (2 * slack) * 2 * slack - shift, set()).add(x)
                for lo, met in windows.items():
                    def stands(key):
                        k = words(key)
                        at = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
                        return any(w[s:s + len(k)] == k for s in range(max(0, lo + at - slack), max(0, lo + at + 3 * slack + 1)))
                    if len(met) >= math.ceil(licenses.SHARE * len(rare)) and all(map(stands, keys)):
                        shares[label] = max(shares.get(label, 0), len(met) / len(rare))
        base = {label for _, label in places}
        out.append((doc_id, len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                    ",".join(sorted(base)), ",".join(sorted(base | set(shares))), 1.0 if places else max(shares.values(), default=0.0)))
    return sorted(out, key=str)


def licensed_rows():
    rng = random.Random(7)
    filler = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    rows = []
    for k, (_, text, _) in enumerate(licenses.TEMPLATES):
        broken = re.sub(r"\w+", lambda m: m[0] if rng.random() > 0.12 else "changed", text)
        spread = text.replace(",", " one two three")
        for j, t in enumerate((text, text.upper(), f"{filler(40)}\n * {text} {filler(30)}", broken, spread,
                               " ".join(reversed(text.split())), text[:len(text) // 2],
                               f"{filler(900)} {text} {filler(500)} {text}")):
            rows.append((1000 + 20 * k + j, t, "en", "s", 1))
    names = ["MIT License", "mit-license mit\tLicense. Apache\x00License", "xmit license", "mit licensé", "general  public _license_ general public",
             "MIT LICENSE " * 3000, "the mit licenKe", "Apache License, the GENERAL PUBLIC LICENSE; MIT (license)", "mit mit license license"]
    return rows + [(5000 + i, t, None, None, None) for i, t in enumerate(names)]


def test_query_against_brute_force(spark, tmp_path):
    rows = awkward_docs() + licensed_rows() + licensed_rows()[:9]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for c in ("words", "hits", "places", "codes", "windows", "notices", "w", "i", "label", "score"):
        docs = docs.withColumn(c, F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op13_licenses(spark, str(tmp_path)).collect()), key=str)
    assert got == brute_force(rows)
    whole = {r[0]: r[6].split(",") for r in got}
    for k, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert label in whole[1000 + 20 * k] and label in whole[1002 + 20 * k] and label in whole[1007 + 20 * k]


def test_plan_is_native(spark, tmp_path):
    df = spark.createDataFrame(awkward_docs(), DOCS)
    passes = [licenses.known_words(df, ["mit"]), licenses.scan(df)]
    plans = [p._jdf.queryExecution().executedPlan().toString() for p in passes]
    assert not any(x in plan for plan in plans for x in ("Python", "Arrow", "Exchange"))
    assert [plan.count("regexp_extract_all(") for plan in plans] == [1, 0]  # texts are split once


def test_empty_table_and_own_templates(spark):
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(1, "Beer Ware licence revision 42", "en", "s", 1), (2, "nothing", "en", "s", 1)], DOCS)
    got = {r["doc_id"]: r for r in licenses.scan(df, [("beer", "beer ware licence revision", ("beer ware",))], {}).collect()}
    assert got[1]["notices"][0]["label"] == "beer" and got[1]["score"] == 1.0 and got[2]["notices"] == [] and got[2]["score"] == 0.0
    assert licenses.scan(df, [], {"beer ware": "b"}).where("score = 1").count() == 1
    assert licenses.scan(df, [], {}).where("score = 0").count() == 2
    with pytest.raises(ValueError):
        licenses.scan(df, [("beer", "beer ware licence", ("other words",))])
