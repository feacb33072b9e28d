import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from campaignlake.llm import mixing

from .tables import DOCS, docs_frame

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets_of(sizes):
    """Water filling, step by step."""
    order = sorted((k for k in sizes if k is not None)) + ([None] if None in sizes else [])
    weight = {k: mixing.WEIGHTS[i % 3] for i, k in enumerate(order)}
    left, capped = mixing.SHARE * sum(sizes.values()), {}
    while True:
        open_ = [k for k in order if k not in capped]
        level = (left - sum(capped.values())) / max(1, sum(weight[k] for k in open_))
        over = [k for k in open_ if level * weight[k] > 2 * sizes[k]]
        if not over:
            return {k: capped.get(k, level * weight[k]) for k in order}
        capped.update({k: 2.0 * sizes[k] for k in over})


def many_docs(n=600):
    return [(i, " ".join(["w"] * (1 + i * 7 % 90)), "en", [f"s{i % 7}", "hot", None][i % 3], 0) for i in range(n)]


@pytest.mark.parametrize("rows", [None, many_docs()])
def test_sizes_targets_and_taken(spark, rows):
    docs = docs_frame(spark, rows)
    got = mixing.mix(docs).collect()
    source = docs.select("doc_id", "source", "text").collect()
    assert len(got) == len(source)
    sizes, expected = defaultdict(int), defaultdict(list)
    for r in source:
        n = len(WORDS.findall(r["text"] or ""))
        sizes[r["source"]] += n
        expected[r["doc_id"]].append(n)
    targets, taken = targets_of(sizes), defaultdict(int)
    for r in got:
        assert r["size"] in expected[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(p["hi"] - p["lo"] for p in r["pieces"])
        taken[r["source"]] += r["taken"]
    for k, t in targets.items():
        assert abs(taken[k] - t) <= max(3, 0.01 * t)
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["first"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


@pytest.mark.parametrize("small", [None, "a"])
def test_small_source_beside_large_ones(spark, small):
    # blocks of 1,500 words; the small source is last (null) or first
    rows = [(i, " ".join(["w"] * 500), "en", f"s{i % 4}", 0) for i in range(20_000)]
    rows += [(90_000 + i, " ".join(["w"] * n), "en", small, 0) for i, n in enumerate((30, 1, 19))]
    got = mixing.mix(docs_frame(spark, rows)).where(F.col("source").eqNullSafe(F.lit(small))).collect()
    assert [r["target"] for r in got] == [100.0] * 3 and [r["taken"] for r in got] == [2 * r["size"] for r in got]


def test_every_source_has_its_target(spark):
    # a hot source, middling ones and small ones
    sizes = {"hot": 4_000_000, **{f"m{i}": 997 * i + 211 for i in range(9)}, **{f"x{i}": 7 * i + 1 for i in range(15)}}
    rows = [(f"{k}:{lo}", min(300, n - lo), k) for k, n in sizes.items() for lo in range(0, n, 300)]
    docs = spark.createDataFrame(rows, "doc_id string, n int, source string").select(
        "doc_id", F.expr("repeat('w ', n)").alias("text"), "source")
    got = mixing.mix(docs).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert len(got) == len(sizes)
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 0.5


def test_schedule_is_even(spark):
    targets = spark.createDataFrame([(1, 600.0), (2, 300.0), (3, 100.0)], "source_no long, target double")
    rows = sorted((r["slot"], r["source_no"], r["rank"]) for r in mixing.schedule(targets, 1).collect())
    assert [r[0] for r in rows] == list(range(1000))
    ranks = defaultdict(list)
    for _, s, rank in rows:
        ranks[s].append(rank)
    assert all(v == list(range(len(v))) for v in ranks.values())
    for lo in range(0, 1000, 100):  # any stretch holds the shares
        part = [s for _, s, _ in rows[lo:lo + 100]]
        assert abs(part.count(1) - 60) <= 3 and abs(part.count(2) - 30) <= 3


def test_no_words_and_empty_table(spark):
    rows = [(1, None, "en", "a", 0), (2, " ", "en", None, 0)]
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(docs_frame(spark, rows)).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_mixed_documents_follow_taken(spark):
    docs = docs_frame(spark, many_docs(200))
    copies = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        copies[r["doc_id"]] += 1
    for r in mixing.mix(docs).collect():
        by_round = defaultdict(int)
        for p in r["pieces"]:
            by_round[p["round"]] += p["hi"] - p["lo"]
        assert copies[r["doc_id"]] == sum(2 * n >= r["size"] for n in by_round.values())
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mixed_documents_are_in_schedule_order(spark, tmp_path):
    docs = docs_frame(spark, many_docs(400) + [(None, "no id", "en", None, 0)] * 2)
    first = {}
    for r in mixing.mix(docs).collect():
        for n in (0, 1):
            part = [p for p in r["pieces"] if p["round"] == n]
            if 2 * sum(p["hi"] - p["lo"] for p in part) >= r["size"]:
                first.setdefault(r["doc_id"], set()).add(min(p["slot"] for p in part))
    mixing.mixed_documents(docs).write.parquet(f"{tmp_path}/mix")
    files = sorted((tmp_path / "mix").glob("part-*.parquet"))
    rows = [r["doc_id"] for f in files for r in spark.read.parquet(str(f)).collect()]
    assert len(files) > 1 and sorted(map(str, rows)) == sorted(str(i) for i, s in first.items() for _ in s)
    got, seen = [], defaultdict(int)
    for i in rows:
        got.append(sorted(first[i])[seen[i]])
        seen[i] += 1
    assert got == sorted(got)


def test_plan_is_native(spark):
    plan = mixing.mix(docs_frame(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan.split("Physical Plan")[1])


def test_texts_of_the_mix_move_once(spark):
    plan = mixing.mixed_documents(docs_frame(spark, many_docs(200)))._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("Initial Plan")[0].splitlines() if "Exchange" in line and "Broadcast" not in line
             and "RoundRobin" not in line]  # the fixture's own
    assert len(moved) == 1 and "passthrough" in moved[0]
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_mixed_documents_with_a_hot_repeated_row(spark):
    rows = many_docs(100) + [(7_000, " ".join(["h"] * 40), "en", "hot", 0)] * 60
    docs = docs_frame(spark, rows)
    expected = defaultdict(int)
    for r in mixing.mix(docs).collect():
        for n in (0, 1):
            part = [p["hi"] - p["lo"] for p in r["pieces"] if p["round"] == n]
            expected[r["doc_id"]] += bool(part) and 2 * sum(part) >= r["size"]
    got = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        got[r["doc_id"]] += 1
    assert got == {k: n for k, n in expected.items() if n} and got[7_000] > 60


def test_schedule_of_many_sources(spark):
    targets = spark.range(3000).select(F.col("id").alias("source_no"), F.lit(10.0).alias("target"))
    got = mixing.schedule(targets, 1).groupBy("source_no").agg(F.count("*").alias("n"), F.max("rank").alias("m"))
    assert got.where("n = 10 and m = 9").count() == 3000
