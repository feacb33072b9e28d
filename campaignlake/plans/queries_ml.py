"""Feature, model and BI queries (B30-B44)."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake.operators import bi, clean, features, lifecycle, marts, model
from campaignlake.plans import oracle_sql as O
from campaignlake.plans.queries_core import ods_banners, q_campaign_daily_full
from campaignlake.plans.registry import ORACLE, SNAPSHOT_DATE, register
from campaignlake.session import new_scratch
from campaignlake.sources import domain as D

SNAP = f"DATE '{SNAPSHOT_DATE}'"

# days before the snapshot: 1 to 7 are in the window, the least is the recency
_ACTIVITY_CTES = (
    f"act AS (SELECT user_id, {SNAP} AS snapshot_date, COUNT(*) AS impressions_7d, "
    "SUM(is_clicked)::BIGINT AS clicks_7d, MIN(ago)::INTEGER AS recency_days, "
    "MAX(device_type) AS device_type, MAX(os) AS os "
    f"FROM (SELECT *, {SNAP} - event_ts::DATE AS ago FROM b) WHERE ago BETWEEN 1 AND 7 GROUP BY user_id)"
)

_FEATURE_CTES = (
    f"{O.base_ctes()}, {_ACTIVITY_CTES}, "
    f"cu AS ({O.users_parsed('(' + D.SQL_RAW_CD_USER + ')')}), "
    "f AS (SELECT act.user_id, act.snapshot_date, act.impressions_7d, act.clicks_7d, "
    f"(SELECT COUNT(*) FROM a WHERE a.user_id = act.user_id AND {SNAP} - a.session_start::DATE BETWEEN 1 AND 7) "
    "AS actions_7d, act.recency_days, act.device_type, act.os, "
    "cu.segment, cu.tariff FROM act LEFT JOIN cu USING (user_id))"
)


def feature_table(spark, sf):
    return features.user_features_7d(
        ods_banners(spark, sf), clean.drop_null_key(D.raw_actions(spark, sf)),
        clean.parse_users(D.raw_cd_user(spark, sf)), SNAPSHOT_DATE)


@register("user_activity_7d", f"WITH {O.base_ctes()}, {_ACTIVITY_CTES} SELECT * FROM act")
def q_user_activity_7d(spark, sf):
    return features.user_activity_7d(ods_banners(spark, sf), SNAPSHOT_DATE)


_LATEST_CTES = _ACTIVITY_CTES.replace(
    "MAX(device_type) AS device_type, MAX(os) AS os",
    "arg_max(device_type, event_ts::VARCHAR || ' ' || event_id) AS device_type, "
    "arg_max(os, event_ts::VARCHAR || ' ' || event_id) AS os")


@register("user_activity_7d_latest", f"WITH {O.base_ctes()}, {_LATEST_CTES} SELECT * FROM act")
def q_user_activity_7d_latest(spark, sf):
    """device_type/os of the latest impression (ties by event_id) instead of max."""
    return features.user_activity_7d(ods_banners(spark, sf), SNAPSHOT_DATE, latest=True)


@register("user_features_7d", f"WITH {_FEATURE_CTES} SELECT * FROM f")
def q_user_features_7d(spark, sf):
    return feature_table(spark, sf)


@register("click_label", f"WITH {_FEATURE_CTES} SELECT *, CAST(COALESCE(clicks_7d, 0) > 0 AS DOUBLE) "
          "AS target_click FROM f")
def q_click_label(spark, sf):
    return model.click_label(feature_table(spark, sf))


def _rank(c: str) -> str:
    return f"CAST(DENSE_RANK() OVER (ORDER BY COALESCE({c}, '__null__')) - 1 AS DOUBLE) AS {c}_idx"


@register("encode_features", f"WITH {_FEATURE_CTES} SELECT user_id, snapshot_date, "
          "COALESCE(impressions_7d, 0) AS impressions_7d, COALESCE(actions_7d, 0) AS actions_7d, "
          "COALESCE(recency_days, 0) AS recency_days, "
          f"{_rank('device_type')}, {_rank('os')}, {_rank('segment')}, {_rank('tariff')} FROM f")
def q_encode_features(spark, sf):
    return model.encode_features(feature_table(spark, sf))


_BID_SQL = (
    "CASE WHEN contains(s, 'high') OR contains(s, 'spend') OR COALESCE(p >= 0.5, false) "
    "THEN 'high_spend +20%' WHEN contains(s, 'low') OR contains(s, 'active') "
    "THEN 'low_active стандарт' ELSE 'стандарт' END"
)


@register("recommend_bid", f"WITH {_FEATURE_CTES}, r AS (SELECT user_id, snapshot_date, "
          "CASE WHEN impressions_7d > 0 THEN clicks_7d / impressions_7d ELSE 0.0 END AS p, segment, "
          "lower(trim(COALESCE(segment, 'default'))) AS s FROM f) "
          f"SELECT user_id, snapshot_date, p AS probability_click, segment, {_BID_SQL} AS recommend_bid FROM r")
def q_recommend_bid(spark, sf):
    """Bid rule on the observed 7-day click rate as the probability column."""
    f = feature_table(spark, sf)
    rate = F.when(F.col("impressions_7d") > 0, F.col("clicks_7d") / F.col("impressions_7d")) \
        .otherwise(F.lit(0.0))
    return model.recommend_bids(f.select("user_id", "snapshot_date", rate.alias("probability_click"),
                                         "segment"))


@register("stratified_split", f"WITH {_FEATURE_CTES}, y AS (SELECT user_id, snapshot_date, "
          "CAST(COALESCE(clicks_7d, 0) > 0 AS DOUBLE) AS target_click, "
          f"sha256(CAST(user_id AS VARCHAR) || ':' || '{model.SPLIT_SEED}') AS h FROM f) "
          "SELECT user_id, snapshot_date, target_click, "
          "CASE WHEN row_number() OVER (PARTITION BY target_click ORDER BY h, user_id) <= "
          f"round({model.TRAIN_FRACTION} * COUNT(*) OVER (PARTITION BY target_click)) "
          "THEN 'train' ELSE 'test' END AS split FROM y")
def q_stratified_split(spark, sf):
    labelled = model.click_label(feature_table(spark, sf))
    return model.split_assignment(labelled).select("user_id", "snapshot_date", model.LABEL, "split")


_SPLIT_SQL = ORACLE["stratified_split"]


@register("train_click_model", "SELECT COUNT(*) FILTER (WHERE split = 'train') AS n_train, "
          "COUNT(*) FILTER (WHERE split = 'test') AS n_test, "
          "CAST(SUM(target_click) FILTER (WHERE split = 'train') AS BIGINT) AS pos_train, "
          "COALESCE(CAST(SUM(target_click) FILTER (WHERE split = 'test') AS BIGINT), 0) AS pos_test, "
          f"true AS auc_is_rank_sum FROM ({_SPLIT_SQL})")
def q_train_click_model(spark, sf):
    """Fit (200 rounds), evaluate on the held-out part, save model + metadata;
    one row: sizes and positives of both parts, and whether the evaluator's
    AUC is the rank-sum AUC of the predictions."""
    m, train, test = model.train_click_model(feature_table(spark, sf))
    auc = model.evaluate_auc(m, test)
    ranked = model.rank_sum_auc(m.transform(test))
    (n_train, pos_train), (n_test, pos_test) = (
        tuple(part.agg(F.count(F.lit(1)), F.coalesce(F.sum(model.LABEL), F.lit(0))).first()) for part in (train, test))
    model.save_model_with_meta(spark, m, new_scratch(spark, "click-model"),
                               {"roc_auc": auc, "n_train": n_train, "n_test": n_test})
    same = bool(abs(auc - ranked) < 1e-6) if 0 < pos_test < n_test else True
    return spark.createDataFrame([(int(n_train), int(n_test), int(pos_train), int(pos_test), same)],
                                 "n_train long, n_test long, pos_train long, pos_test long, auc_is_rank_sum boolean")


@register("score_users", f"WITH {_FEATURE_CTES} SELECT user_id, snapshot_date, COALESCE(segment, 'default') AS segment, "
          "true AS probability_in_range, true AS bid_follows_rule FROM f")
def q_score_users(spark, sf):
    """Train, save, load by its path and score; the predictions are written to
    the snapshot-partitioned table (B40), read back and held against the
    rules."""
    path = new_scratch(spark, "click-model")
    feats = lifecycle.stage(feature_table(spark, sf), name="features")
    trained, _, _ = model.train_click_model(feats)
    model.save_model_with_meta(spark, trained, path, {})
    m, _ = model.load_model_with_meta(spark, path)
    out = lifecycle.write_predictions(model.score_users(m, feats), new_scratch(spark, "ml-click-predictions"))
    p = F.col("probability_click")
    rule = model.recommend_bids(spark.read.parquet(out).withColumnRenamed("recommend_bid", "_bid"))
    return rule.select("user_id", "snapshot_date", "segment", p.between(0.0, 1.0).alias("probability_in_range"),
                       (F.col("_bid") == F.col("recommend_bid")).alias("bid_follows_rule"))


# --- BI -----------------------------------------------------------------------

_MART = f"{O.base_ctes()}, {O.mart_ctes('b', 'i', 'a')}, mart AS ({O.mart_select('c')})"


@register("ctr_by_campaign", f"WITH {_MART}, g AS (SELECT campaign_id, CAST(SUM(impressions) AS BIGINT) "
          "AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(CAST(round(ctr * 10000) AS BIGINT)) "
          "AS BIGINT) AS u, COUNT(*) AS days FROM mart GROUP BY campaign_id) SELECT campaign_id, impressions, "
          f"clicks, {O.half_up('clicks * 100', 'impressions', 4)} AS ctr, "
          f"{O.half_up('u', 'days', 0)} / CAST(10000 AS DOUBLE) AS avg_daily_ctr, days FROM g")
def q_ctr_by_campaign(spark, sf):
    return bi.ctr_by_campaign(q_campaign_daily_full(spark, sf))


@register("traffic_by_day", f"WITH {_MART} SELECT date, CAST(SUM(impressions) AS BIGINT) AS impressions, "
          "CAST(SUM(clicks) AS BIGINT) AS clicks FROM mart GROUP BY date")
def q_traffic_by_day(spark, sf):
    """From the daily impressions and clicks alone; installs and actions have
    no part in it."""
    return bi.traffic_by_day(marts.reject_null_keys(marts.daily_banner_stats(ods_banners(spark, sf))))


TABLE_ROWS = 100


@register("campaign_table", f"WITH {_MART} SELECT {', '.join(bi.TABLE_COLUMNS)} FROM mart "
          f"ORDER BY date, campaign_id LIMIT {TABLE_ROWS}")
def q_campaign_table(spark, sf):
    """The dashboard table with a cap below the rows of the mart."""
    return bi.campaign_table(q_campaign_daily_full(spark, sf), limit=TABLE_ROWS)


@register("preview", f"WITH {_MART} SELECT * FROM mart ORDER BY date, campaign_id LIMIT {bi.PREVIEW_ROWS}")
def q_preview(spark, sf):
    return bi.preview(q_campaign_daily_full(spark, sf), order=("date", "campaign_id"))
