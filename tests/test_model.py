"""Click model on MLlib (few boosting rounds in tests)."""

import pytest
from pyspark.sql import functions as F

from campaignlake.operators import model
from campaignlake.plans.queries_ml import feature_table
from campaignlake.session import new_scratch
from tests.conftest import SF_CHECK


def test_train_score_and_evaluate(spark):
    feats = feature_table(spark, SF_CHECK)
    m, train, test = model.train_click_model(feats, maxIter=5)
    assert train.count() + test.count() == feats.count()
    auc = model.evaluate_auc(m, test)
    assert 0.0 <= auc <= 1.0
    pred = m.transform(test)
    assert abs(model.rank_sum_auc(pred) - auc) < 1e-6
    scored = model.score_users(m, feats)
    rows = scored.collect()
    assert len(rows) == feats.count() == len({r.user_id for r in rows})
    assert all(0.0 <= r.probability_click <= 1.0 for r in rows)
    assert all(r.recommend_bid in ("high_spend +20%", "low_active стандарт", "стандарт") for r in rows)
    path = new_scratch(spark, "t-model")
    model.save_model_with_meta(spark, m, path, {"roc_auc": auc})
    loaded, meta = model.load_model_with_meta(spark, path)
    assert meta["roc_auc"] == auc and "segment" in meta["feature_columns"]
    again = model.score_users(loaded, feats).orderBy("user_id").collect()
    assert [r.probability_click for r in again] == [r.probability_click for r in sorted(rows, key=lambda r: r.user_id)]


def test_split_is_stable_and_label_balanced(spark):
    feats = model.click_label(feature_table(spark, SF_CHECK))
    a = {r.user_id: r.split for r in model.split_assignment(feats).collect()}
    b = {r.user_id: r.split for r in model.split_assignment(feats).collect()}
    assert a == b
    share = sum(1 for v in a.values() if v == "train") / len(a)
    assert 0.65 < share < 0.95


def test_encoded_categories_are_alphabetical(spark):
    enc = model.encode_features(feature_table(spark, SF_CHECK))
    dev = {r.device_type_idx for r in enc.collect()}
    assert dev <= {0.0, 1.0}


def test_training_with_forty_tariffs(spark, monkeypatch):
    feats = feature_table(spark, SF_CHECK).withColumn("tariff", F.concat(F.lit("t"), (F.col("user_id") % 40).cast("string")))
    m, _, test = model.train_click_model(feats, maxIter=2)
    assert m.stages[-1].getOrDefault("maxBins") >= 41 and 0 <= model.evaluate_auc(m, test) <= 1
    monkeypatch.setattr(model, "MOST_CATEGORIES", 10)
    with pytest.raises(ValueError, match="tariff"):
        model.train_click_model(feats, maxIter=2)


def test_score_users_trains_the_full_model(spark, monkeypatch):
    from campaignlake.plans import queries_ml

    class Asked(Exception):
        pass

    def train(feats, **overrides):
        raise Asked(overrides)

    monkeypatch.setattr(queries_ml, "feature_table", lambda spark, sf: spark.range(1))
    monkeypatch.setattr(queries_ml.model, "train_click_model", train)
    with pytest.raises(Asked) as asked:
        queries_ml.q_score_users(spark, "")
    assert asked.value.args == ({},) and queries_ml.model.GBT_PARAMS["maxIter"] == 200


def test_split_is_exact_for_every_label(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 11 == 0, 1.0).when(F.col("id") < 3, None).otherwise(0.0).alias(model.LABEL))
    train, test = model.stratified_split(rows)
    got = {r[0]: r[1] for r in train.groupBy(model.LABEL).count().collect()}
    every = {r[0]: r[1] for r in rows.groupBy(model.LABEL).count().collect()}
    assert got == {k: round(0.8 * n) for k, n in every.items()} and train.columns == rows.columns
    assert train.count() + test.count() == 30_000 and not train.join(test, "user_id", "left_semi").count()
    again, _ = model.stratified_split(rows.repartition(7))
    assert not again.select("user_id").exceptAll(train.select("user_id")).count()
    assert model.split_assignment(rows.limit(0)).count() == 0


def test_auc_of_many_distinct_scores(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(100_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(40_000)) / 40_000.0).alias("p"), F.rand(5).alias("u"))
    rows = rows.select((1 - F.col("p")).alias("q"), "p", (F.col("u") < F.col("p")).cast("double").alias(model.LABEL))
    for name in ("probability", "rawPrediction"):
        rows = VectorAssembler(inputCols=["q", "p"], outputCol=name).transform(rows)
    rows = rows.cache()
    pdf = rows.select("p", model.LABEL).toPandas()
    ranks, y = pdf["p"].rank().to_numpy(), pdf[model.LABEL].to_numpy()
    n = y.sum()
    expected = (ranks[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))
    assert rows.select("p").distinct().count() > 30_000
    assert abs(model.rank_sum_auc(rows) - expected) < 1e-9 and abs(model.auc(rows) - expected) < 1e-9
    rows.unpersist()
