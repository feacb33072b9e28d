"""Click model on MLlib: label, encoding, split, boosted trees, scoring.

The whole path stays in Spark: the feature table is checkpointed into the
shared scratch folder (lineage cut, survives executor loss), a single
``Pipeline`` holds the category indexers, the assembler and the classifier,
so category codes fitted at training are the codes used at scoring.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campaignlake.functions import columns as C
from campaignlake.operators.lifecycle import stage
from campaignlake.session import scratch_root

# Feature list (de-duplicated), placeholder for a missing
# category, label definition and the boosted-tree hyper-parameters.
NUMERIC_FEATURES = ("impressions_7d", "actions_7d", "recency_days")
CATEGORICAL_FEATURES = ("device_type", "os", "segment", "tariff")
NULL_CATEGORY = "__null__"
LABEL = "target_click"
GBT_PARAMS = dict(maxIter=200, maxDepth=6, stepSize=0.05, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8
LEAST_BINS = 32          # MLlib's default
MOST_CATEGORIES = 10_000  # values of one category: the indexer brings them to the driver


# B32 -----------------------------------------------------------------------
def click_label(features: DataFrame) -> DataFrame:
    """target_click = 1.0 when the user clicked in the window, else 0.0.
    clicks_7d itself is never a model input."""
    return features.withColumn(LABEL, (F.coalesce(F.col("clicks_7d"), F.lit(0)) > 0).cast("double"))


def fill_features(features: DataFrame) -> DataFrame:
    """NULL category -> '__null__', NULL number -> 0."""
    cols = []
    for c in features.columns:
        if c in CATEGORICAL_FEATURES:
            cols.append(F.coalesce(F.col(c), F.lit(NULL_CATEGORY)).alias(c))
        elif c in NUMERIC_FEATURES:
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
        else:
            cols.append(F.col(c))
    return features.select(*cols)


def _indexer() -> StringIndexer:
    return StringIndexer(inputCols=list(CATEGORICAL_FEATURES),
                         outputCols=[f"{c}_idx" for c in CATEGORICAL_FEATURES],
                         handleInvalid="keep", stringOrderType="alphabetAsc")


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(NUMERIC_FEATURES) + [f"{c}_idx" for c in CATEGORICAL_FEATURES],
                           outputCol="features", handleInvalid="keep")


# B33 -----------------------------------------------------------------------
def encode_features(features: DataFrame) -> DataFrame:
    """Category codes (alphabetical, NULL as '__null__') and filled numbers,
    as plain columns: user_id, snapshot_date, the numeric features and
    ``<category>_idx`` doubles."""
    filled = stage(fill_features(features).select(
        "user_id", "snapshot_date", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES), name="features")
    model = fit_indexer(filled)
    coded = model.transform(filled)
    return coded.select("user_id", "snapshot_date", *NUMERIC_FEATURES,
                        *[f"{c}_idx" for c in CATEGORICAL_FEATURES])


# B34 -----------------------------------------------------------------------
def split_assignment(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED,
                     user_col: str = "user_id", label: str = LABEL) -> DataFrame:
    """The split as a column: ``split`` = 'train' or 'test'.  Of the n rows of
    each label, the round(fraction * n) first ones in the order of SHA-256 of
    'user:seed' (then user and snapshot) are 'train'.

    Rows are counted by label and range of the hash first; the running count
    names the range in which the cut lies, and only its rows are ranked.  A
    label with a third of all rows or more is never gathered in one task."""
    data = stage(df.withColumn("_hash", F.sha2(F.concat_ws(":", F.col(user_col).cast("string"), F.lit(str(seed))), 256))
                 .withColumn("_range", F.substring("_hash", 1, 4)).withColumn("_label", F.struct(label)), name="split")
    every = Window.partitionBy("_label")
    ahead = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (data.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("n"))
            .select("_label", "_range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
                    F.round(F.sum("n").over(every) * F.lit(fraction)).cast("long").alias("wanted"))
            .where(F.col("before") < F.col("wanted")).groupBy("_label")
            .agg(F.max(F.struct("_range", F.col("wanted") - F.col("before"))).alias("_cut"))
            .select("_label", F.col("_cut._range").alias("_last"), F.col("_cut.col2").alias("_rest")))
    placed = data.join(cuts, "_label", "left")
    at_cut = F.coalesce(F.col("_range") == F.col("_last"), F.lit(False))
    order = ["_hash", user_col, *[c for c in ("snapshot_date",) if c in df.columns]]
    ranked = placed.where(at_cut).withColumn("_n", F.row_number().over(every.orderBy(*order)))
    name = lambda train: F.when(train, F.lit("train")).otherwise(F.lit("test")).alias("split")
    return (placed.where(~at_cut).select(*df.columns, name(F.col("_range") < F.col("_last")))
            .union(ranked.select(*df.columns, name(F.col("_n") <= F.col("_rest")))))


def stratified_split(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED,
                     user_col: str = "user_id", label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """Train and test parts of ``split_assignment``, staged once."""
    parts = stage(split_assignment(df, fraction, seed, user_col, label), name="parts")
    return tuple(parts.where(F.col("split") == part).drop("split") for part in ("train", "test"))


# B35 -----------------------------------------------------------------------
def fit_indexer(filled: DataFrame) -> StringIndexerModel:
    """Category codes of ``filled``; an error above ``MOST_CATEGORIES`` values
    of one category, counted before any of them is collected."""
    counts = filled.agg(*[F.approx_count_distinct(c).alias(c) for c in CATEGORICAL_FEATURES]).first().asDict()
    large = {c: n for c, n in counts.items() if n > MOST_CATEGORIES}
    if large:
        raise ValueError(f"too many category values (at most {MOST_CATEGORIES}): {large}")
    return _indexer().fit(filled)


def click_model_pipeline(indexer: StringIndexerModel, **overrides) -> Pipeline:
    """Codes, assembler and boosted trees; every category value, and the one
    kept for unseen values, has a bin of its own."""
    bins = max(LEAST_BINS, *(len(labels) + 1 for labels in indexer.labelsArray))
    params = {**GBT_PARAMS, "maxBins": bins, **overrides}
    gbt = GBTClassifier(featuresCol="features", labelCol=LABEL, checkpointInterval=10, **params)
    return Pipeline(stages=[indexer, _assembler(), gbt])


def prepare_training(features: DataFrame) -> DataFrame:
    """Label + filled features, merged to partitions of the advisory size and
    checkpointed to the shared scratch folder."""
    scratch_root(features.sparkSession)
    return fill_features(click_label(features)).hint("rebalance").checkpoint(eager=True)


def train_click_model(features: DataFrame, **overrides) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit on the train part; returns (model, train, test)."""
    data = prepare_training(features)
    train, test = stratified_split(data)
    model = click_model_pipeline(fit_indexer(train), **overrides).fit(train)
    return model, train, test


# B36 -----------------------------------------------------------------------
def evaluate_auc(model: PipelineModel, test: DataFrame) -> float:
    """ROC-AUC on the held-out part (target > 0.8)."""
    return auc(model.transform(test))


def auc(predictions: DataFrame) -> float:
    """ROC-AUC of scored rows, with a point of the curve for every distinct score."""
    ev = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(predictions))


def rank_sum_auc(predictions: DataFrame) -> float:
    """ROC-AUC as the rank-sum statistic of the predicted probabilities, ties
    counting half: distinct probabilities in ranges, running sums of the
    ranges' totals, then inside each range."""
    by = (predictions.groupBy(vector_to_array("probability")[1].alias("p"))
          .agg(F.sum(LABEL).alias("pos"), F.sum(1 - F.col(LABEL)).alias("neg")))
    by = stage(by.repartitionByRange("p").withColumn("part", F.spark_partition_id()), name="ranges")
    def ahead(window):
        return F.coalesce(F.sum("neg").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))

    parts = by.groupBy("part").agg(F.sum("neg").alias("neg")).select("part", ahead(Window.orderBy("part")).alias("before"))
    below = F.col("before") + ahead(Window.partitionBy("part").orderBy("p"))
    r = (by.join(parts, "part").withColumn("wins", F.col("pos") * (below + F.col("neg") / 2))
         .agg(F.sum("wins"), F.sum("pos"), F.sum("neg")).first())
    return float(r[0] / (r[1] * r[2])) if r[1] and r[2] else float("nan")


# B37 -----------------------------------------------------------------------
def save_model_with_meta(spark: SparkSession, model: PipelineModel, path: str, meta: dict) -> None:
    """Model directory plus a one-row JSON metadata table at ``path``_meta."""
    model.write().overwrite().save(path)
    meta = dict(meta)
    meta.setdefault("feature_columns", list(NUMERIC_FEATURES) + list(CATEGORICAL_FEATURES))
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string") \
        .coalesce(1).write.mode("overwrite").text(path + "_meta")


def load_model_with_meta(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(path)
    meta_rows = spark.read.text(path + "_meta").take(1)
    return model, (json.loads(meta_rows[0][0]) if meta_rows else {})


# B38 / B39 -----------------------------------------------------------------
def score_users(model: PipelineModel, features: DataFrame, snapshot_date: str | None = None) -> DataFrame:
    """probability_click per user and the bid recommendation; the raw segment
    is kept beside its code (NULL shown as 'default')."""
    df = features
    if "snapshot_date" not in df.columns:
        df = df.withColumn("snapshot_date", F.lit(snapshot_date).cast("date") if snapshot_date
                           else F.current_date())
    raw_segment = df.select("user_id", "snapshot_date", F.col("segment").alias("_segment_raw"),
                            *[c for c in df.columns if c not in ("user_id", "snapshot_date", "segment")],
                            "segment")
    scored = model.transform(fill_features(raw_segment))
    p = vector_to_array("probability")[1]
    return scored.select(
        "user_id", "snapshot_date", p.alias("probability_click"),
        F.coalesce(F.col("_segment_raw"), F.lit("default")).alias("segment"),
        C.recommend_bid(F.col("_segment_raw"), p).alias("recommend_bid"))


def recommend_bids(df: DataFrame, probability: str = "probability_click") -> DataFrame:
    """Add ``recommend_bid`` from ``segment`` and a probability column."""
    return df.withColumn("recommend_bid", C.recommend_bid("segment", probability))
