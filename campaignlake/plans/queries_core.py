"""Cleaning and mart queries (B11-B29, B53)."""

from __future__ import annotations

from campaignlake.operators import clean, marts
from campaignlake.plans import oracle_sql as O
from campaignlake.plans.registry import PROCESSING_DATE, register
from campaignlake.sources import domain as D


def ods_banners(spark, sf):
    return clean.clean_banner_events(D.raw_banner_events(spark, sf))


# --- cleaning ---------------------------------------------------------------

@register("drop_null_key", f"WITH raw_b AS ({D.SQL_RAW_BANNER_EVENTS}) "
          "SELECT * FROM raw_b WHERE user_id IS NOT NULL")
def q_drop_null_key(spark, sf):
    return clean.drop_null_key(D.raw_banner_events(spark, sf), "user_id")


@register("clean_banner_events", f"WITH {O.base_ctes()} SELECT * FROM b")
def q_clean_banner_events(spark, sf):
    return ods_banners(spark, sf)


@register("dedup_report", f"WITH raw_b AS ({D.SQL_RAW_BANNER_EVENTS}) SELECT "
          "CAST(COUNT(*) AS BIGINT) AS rows_read, CAST(COUNT(user_id) AS BIGINT) AS rows_with_user, "
          "CAST((SELECT COUNT(*) FROM (SELECT DISTINCT banner_id, user_id, event_ts FROM raw_b "
          "WHERE user_id IS NOT NULL)) AS BIGINT) AS rows_deduplicated FROM raw_b")
def q_dedup_report(spark, sf):
    return clean.dedup_report(D.raw_banner_events(spark, sf))


@register("dedup_dimension", f"WITH r AS ({D.SQL_RAW_CD_BANNER}) {O.banners_parsed('r')}")
def q_dedup_dimension(spark, sf):
    return clean.parse_banners(D.raw_cd_banner(spark, sf))


@register("dedup_within_window",
          f"WITH raw_b AS ({D.SQL_RAW_BANNER_EVENTS_NEAR}), w AS (SELECT *, lag(event_ts) OVER "
          "(PARTITION BY banner_id, user_id ORDER BY event_ts, event_id) AS prev FROM raw_b "
          "WHERE user_id IS NOT NULL) SELECT * EXCLUDE (prev) FROM w "
          "WHERE prev IS NULL OR event_ts - prev >= INTERVAL 10 MINUTE")
def q_dedup_within_window(spark, sf):
    raw = clean.drop_null_key(D.raw_banner_events_with_near_copies(spark, sf), "user_id")
    return clean.dedup_within_window(raw, minutes=10)


@register("parse_budget_and_dates", f"WITH r AS ({D.SQL_RAW_CD_CAMPAIGN}) {O.campaigns_parsed('r')}")
def q_parse_budget(spark, sf):
    return clean.parse_campaigns(D.raw_cd_campaign(spark, sf))


@register("blank_safe_date", f"WITH r AS ({D.SQL_RAW_CD_USER}) {O.users_parsed('r')}")
def q_blank_safe_date(spark, sf):
    return clean.parse_users(D.raw_cd_user(spark, sf))


@register("normalize_null_text", f"WITH r AS ({D.SQL_RAW_CD_USER}) SELECT user_id, "
          f"{O.null_if_blank('segment')} AS segment, {O.null_if_blank('tariff')} AS tariff, "
          f"{O.null_if_blank('date_create')} AS date_create, {O.null_if_blank('date_end')} AS date_end "
          "FROM r")
def q_normalize_null_text(spark, sf):
    return clean.normalize_null_text(D.raw_cd_user(spark, sf))


@register("event_identity", f"WITH {O.base_ctes()} SELECT banner_id, user_id, event_ts, "
          f"{O.event_identity()} AS event_id FROM b")
def q_event_identity(spark, sf):
    b = ods_banners(spark, sf).select("banner_id", "user_id", "event_ts")
    return clean.add_event_identity(b)


_CHECKS_SQL = (
    f"WITH {O.base_ctes()}, cb AS ({D.SQL_RAW_CD_BANNER}), cc AS ({D.SQL_RAW_CD_CAMPAIGN}), "
    f"cu AS ({D.SQL_RAW_CD_USER}) "
    "SELECT 'duplicate_key' AS \"check\", 'cd_banner' AS relation, CAST(COUNT(banner_id) - COUNT(DISTINCT banner_id) AS BIGINT) AS violations FROM cb "
    "UNION ALL SELECT 'duplicate_key', 'cd_campaign', CAST(COUNT(campaign_id) - COUNT(DISTINCT campaign_id) AS BIGINT) FROM cc "
    "UNION ALL SELECT 'duplicate_key', 'cd_user', CAST(COUNT(user_id) - COUNT(DISTINCT user_id) AS BIGINT) FROM cu "
    "UNION ALL SELECT 'orphan', 'banner_events.banner_id->cd_banner', CAST(COUNT(*) AS BIGINT) FROM b "
    "WHERE banner_id IS NOT NULL AND banner_id NOT IN (SELECT banner_id FROM cb WHERE banner_id IS NOT NULL) "
    "UNION ALL SELECT 'orphan', 'banner_events.campaign_id->cd_campaign', CAST(COUNT(*) AS BIGINT) FROM b "
    "WHERE campaign_id IS NOT NULL AND campaign_id NOT IN (SELECT campaign_id FROM cc WHERE campaign_id IS NOT NULL) "
    "UNION ALL SELECT 'orphan', 'banner_events.user_id->cd_user', CAST(COUNT(*) AS BIGINT) FROM b "
    "WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM cu WHERE user_id IS NOT NULL) "
    "UNION ALL SELECT 'orphan', 'installs.user_id->cd_user', CAST(COUNT(*) AS BIGINT) FROM i "
    "WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM cu WHERE user_id IS NOT NULL) "
    "UNION ALL SELECT 'orphan', 'fct_actions.user_id->cd_user', CAST(COUNT(*) AS BIGINT) FROM a "
    "WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM cu WHERE user_id IS NOT NULL)"
)


@register("check_relations", _CHECKS_SQL)
def q_check_relations(spark, sf):
    return clean.check_relations(
        ods_banners(spark, sf), D.raw_installs(spark, sf), D.raw_actions(spark, sf),
        D.raw_cd_banner(spark, sf), D.raw_cd_campaign(spark, sf), D.raw_cd_user(spark, sf))


@register("stamp_processing_date", f"WITH i AS ({D.SQL_RAW_INSTALLS}) SELECT *, "
          f"DATE '{PROCESSING_DATE}' AS processing_date FROM i WHERE user_id IS NOT NULL")
def q_stamp_processing_date(spark, sf):
    return clean.stamp_processing_date(clean.drop_null_key(D.raw_installs(spark, sf)), PROCESSING_DATE)


# --- marts ------------------------------------------------------------------

@register("daily_banner_stats", f"WITH {O.base_ctes()} {O.DAILY.format(b='b')}")
def q_daily_banner_stats(spark, sf):
    return marts.daily_banner_stats(ods_banners(spark, sf))


@register("exposure_set", f"WITH {O.base_ctes()} {O.EXPOSURE.format(b='b')}")
def q_exposure_set(spark, sf):
    return marts.exposure_set(ods_banners(spark, sf))


@register("attribute_installs", f"WITH {O.base_ctes()}, e AS ({O.EXPOSURE.format(b='b')}) "
          f"{O.INSTALLS.format(i='i', e='e')}")
def q_attribute_installs(spark, sf):
    return marts.attribute_installs(D.raw_installs(spark, sf), marts.exposure_set(ods_banners(spark, sf)))


@register("attribute_actions", f"WITH {O.base_ctes()}, e AS ({O.EXPOSURE.format(b='b')}) "
          f"{O.ACTIONS.format(a='a', e='e')}")
def q_attribute_actions(spark, sf):
    return marts.attribute_actions(D.raw_actions(spark, sf), marts.exposure_set(ods_banners(spark, sf)))


@register("campaign_daily_full", O.full_mart())
def q_campaign_daily_full(spark, sf):
    return marts.campaign_daily_full(ods_banners(spark, sf), clean.drop_null_key(D.raw_installs(spark, sf)),
                                     clean.drop_null_key(D.raw_actions(spark, sf)), PROCESSING_DATE)


@register("campaign_daily_lite", f"WITH {O.base_ctes()} SELECT CAST(campaign_id AS BIGINT) AS campaign_id, "
          "event_date AS date, COUNT(*) AS impressions, CAST(COALESCE(SUM(is_clicked), 0) AS BIGINT) AS clicks, "
          "CASE WHEN COUNT(*) > 0 THEN COALESCE(SUM(is_clicked), 0) / COUNT(*) ELSE 0.0 END AS ctr, "
          "CAST(0 AS BIGINT) AS installs, CAST(0 AS BIGINT) AS conversions, 0.0::DOUBLE AS revenue, "
          "0.0::DOUBLE AS cpc, 0.0::DOUBLE AS cpm, 0.0::DOUBLE AS conversion_rate, "
          f"DATE '{PROCESSING_DATE}' AS processing_date FROM b GROUP BY campaign_id, event_date")
def q_campaign_daily_lite(spark, sf):
    return marts.campaign_daily_lite(ods_banners(spark, sf), PROCESSING_DATE)


@register("campaign_budget_metrics",
          f"WITH {O.base_ctes()}, cc AS ({O.campaigns_parsed('(' + D.SQL_RAW_CD_CAMPAIGN + ')')}), "
          "s AS (SELECT campaign_id, COUNT(*) AS impressions, CAST(SUM(is_clicked) AS BIGINT) AS clicks "
          "FROM b GROUP BY campaign_id), j AS (SELECT cc.campaign_id, cc.daily_budget, cc.start_date, "
          "cc.end_date, COALESCE(s.impressions, 0) AS impressions, COALESCE(s.clicks, 0) AS clicks "
          "FROM cc LEFT JOIN s ON cc.campaign_id = s.campaign_id) SELECT *, "
          "CASE WHEN impressions > 0 THEN daily_budget * 1000 / impressions ELSE 0.0 END AS calculated_cpm, "
          "CASE WHEN clicks > 0 THEN daily_budget / clicks ELSE 0.0 END AS calculated_cpc FROM j")
def q_campaign_budget_metrics(spark, sf):
    return marts.campaign_budget_metrics(ods_banners(spark, sf),
                                         clean.parse_campaigns(D.raw_cd_campaign(spark, sf)))
