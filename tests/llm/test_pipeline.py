import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from campaignlake.llm import langid, pii, setjoin
from campaignlake.llm.common import remainder, written

from .tables import DOCS, docs_frame
from .test_text import language_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark):
    rows = [(i, t, k, f"s{i % 3}", len(t)) for i, t, k, _, _ in language_rows(120)]
    mail = "ann.lee@mail.example.com"
    rows += [(500, rows[3][1], "xx", "s1", 5), (501, rows[4][1] + " mi", "yy", "s1", 5), (502, "?? 12 --", None, "s1", 8),
             (503, None, None, None, None), (504, rows[0][1][::-1] + f" kalomi {mail} lomi", None, "s2", 9)]
    docs = docs_frame(spark, rows, clash=False)
    kept, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = written(stage(spark, kept, ""), name)
        seen[name] = kept.collect()
        if name != "pack":
            assert kept.columns == COLUMNS
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "personal_data", "source_mix", "pack"]
    first = {r["doc_id"] for r in seen["language_id"]}
    assert {r["doc_id"] for r in langid.accepted(docs, remainder("doc_id", 4) != 2).collect()} == first
    assert not {502, 503} & first and len(first) >= 120
    second = {r["doc_id"] for r in seen["near_duplicates"]}
    assert first - second == {500, 501}
    third = {r["doc_id"]: r["text"] for r in seen["personal_data"]}
    assert set(third) == second and mail not in third[504] and "<email>" in third[504]
    assert all(not pii.base_spans(t) for t in third.values())
    mixed = Counter(r["doc_id"] for r in seen["source_mix"])
    assert set(mixed) <= second and max(mixed.values()) <= 2
    packed = Counter()
    for r in seen["pack"]:
        packed[r["doc_id"]] += r["length"]
    tokens = {r["doc_id"]: r["doc_tokens"] for r in seen["pack"]}
    assert packed == Counter({k: tokens[k] * n for k, n in mixed.items()})


def test_empty_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, ""), name)
        assert docs.count() == 0


def test_run_reads_documents(spark, tmp_path):
    docs_frame(spark, [(i, t, k, "s", 0) for i, t, k, _, _ in language_rows(30)], clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_stages_hand_small_batches_to_python(spark):
    docs = spark.createDataFrame([(1, "one two three", "en")], "doc_id long, text string, lang string")
    names = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before = {n: spark.conf.get(n) for n in names}
    rows = spark.range(0, 6000, 1, 1).withColumn("text", F.repeat(F.lit("x"), F.when(F.col("id") < 4000, 10).otherwise(9000)))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "source_mix":  # no Python
                continue
            for n in names:
                spark.conf.set(n, before[n])
            stage(spark, docs, "")
            seen = rows.mapInArrow(sizes, "n long, size long").collect()
            assert sum(r["n"] for r in seen) == 6000
            assert max(r["n"] for r in seen) <= 2000 and max(r["size"] for r in seen) < 9 << 20
    finally:
        for n in names:
            spark.conf.set(n, before[n])


def test_near_duplicates_move_a_text_once(spark, monkeypatch):
    # unrelated texts that share shingles; were they one group, each would go to every pair of its blocks
    rng, placed = random.Random(6), []
    rows = [(i, " ".join(f"v{rng.randrange(6)}" for _ in range(90)), "en", "s", 0) for i in range(300)]
    rows += [(300 + i, rows[i][1] + " end", "en", "s", 0) for i in range(10)]

    def counted(df, name):
        out = written(df, name)
        if name == "placed":
            placed.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "written", counted)
    monkeypatch.setattr(setjoin, "BLOCK_SHINGLES", 4000)
    kept = corpus_pipeline.near_duplicates(spark, docs_frame(spark, rows, clash=False), "").collect()
    assert {r["doc_id"] for r in kept} == set(range(300))
    assert 20 <= placed[0] <= len(rows)
