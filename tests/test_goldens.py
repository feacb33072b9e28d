"""Operators on the hand fixture against hand-computed goldens."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campaignlake.functions import columns as C
from campaignlake.functions.names import clean_name
from campaignlake.operators import clean, features, marts
from tests import fixtures as X


def test_dedup_report(spark):
    r = clean.dedup_report(X.banners(spark)).collect()[0]
    assert (r.rows_read, r.rows_with_user, r.rows_deduplicated) == (7, 6, 5)


def test_dedup_survivor_is_deterministic(spark):
    out = clean.clean_banner_events(X.banners(spark))
    ids = sorted(r.event_id for r in out.collect())
    assert ids == ["e1", "e3", "e4", "e6", "e7"]


def test_dedup_idempotent(spark):
    once = clean.clean_banner_events(X.banners(spark))
    twice = clean.clean_banner_events(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def _mart(spark):
    b = clean.clean_banner_events(X.banners(spark))
    return marts.campaign_daily_full(b, X.installs(spark), X.actions(spark), "2025-02-10")


def test_campaign_daily_full_goldens(spark):
    rows = {(r.date.isoformat(), r.campaign_id): r for r in _mart(spark).collect()}
    assert set(rows) == {("2025-02-01", 1), ("2025-02-01", 2), ("2025-02-02", 1)}
    r = rows[("2025-02-01", 1)]
    assert (r.impressions, r.clicks, r.installs, r.conversions, r.revenue) == (3, 1, 1, 2, 160.0)
    assert (r.ctr, r.cpc, r.cpm, r.conversion_rate) == (33.3333, 160.0, 53333.33, 100.0)
    r = rows[("2025-02-01", 2)]
    assert (r.impressions, r.clicks, r.installs, r.conversions, r.revenue) == (1, 0, 1, 1, 110.0)
    assert (r.ctr, r.cpc, r.cpm, r.conversion_rate) == (0.0, 0.0, 110000.0, 0.0)
    r = rows[("2025-02-02", 1)]
    assert (r.impressions, r.clicks, r.installs, r.conversions, r.revenue) == (1, 0, 0, 1, 0.0)
    assert (r.ctr, r.cpc, r.cpm, r.conversion_rate) == (0.0, 0.0, 0.0, 0.0)
    assert all(r.processing_date == dt.date(2025, 2, 10) for r in rows.values())


def test_fan_out_regression_guard(spark):
    """Joining actions to every impression would give revenue 270 for
    (2025-02-01, campaign 1); distinct exposure gives 160."""
    b = clean.clean_banner_events(X.banners(spark)).withColumn("date", F.to_date("event_ts"))
    a = X.actions(spark).filter(~C.is_blank("actions")).withColumn("date", F.to_date("session_start"))
    fan = (a.join(b.select("user_id", "date", "campaign_id"), ["user_id", "date"])
           .groupBy("date", "campaign_id").agg(F.sum(C.action_revenue()).alias("rev")))
    fan_rev = {(r.date.isoformat(), r.campaign_id): r.rev for r in fan.collect()}
    assert fan_rev[("2025-02-01", 1)] == 270
    ours = {(r.date.isoformat(), r.campaign_id): r.revenue for r in _mart(spark).collect()}
    assert ours[("2025-02-01", 1)] == 160.0
    assert all(ours[k] <= fan_rev.get(k, 0) for k in ours)


def test_mart_invariants(spark):
    b = clean.clean_banner_events(X.banners(spark))
    m = _mart(spark).collect()
    assert sum(r.impressions for r in m) == b.count()
    assert all(r.clicks <= r.impressions for r in m)


def test_mart_without_optional_inputs_gives_zeros(spark):
    b = clean.clean_banner_events(X.banners(spark))
    m = marts.campaign_daily_full(b, None, None, "2025-02-10").collect()
    assert all(r.installs == 0 and r.conversions == 0 and r.revenue == 0.0 for r in m)


def test_campaign_budget_metrics(spark):
    b = clean.clean_banner_events(X.banners(spark))
    out = {r.campaign_id: r for r in
           marts.campaign_budget_metrics(b, clean.parse_campaigns(X.campaigns_raw(spark))).collect()}
    assert (out[1].impressions, out[1].clicks, out[1].calculated_cpm, out[1].calculated_cpc) == \
        (4, 1, 43767857.5, 175071.43)
    assert (out[2].impressions, out[2].clicks, out[2].calculated_cpm, out[2].calculated_cpc) == \
        (1, 0, 95601860.0, 0.0)
    assert (out[3].impressions, out[3].clicks, out[3].calculated_cpm, out[3].calculated_cpc) == (0, 0, 0.0, 0.0)
    assert out[1].start_date == dt.date(2025, 2, 1) and out[1].end_date == dt.date(2025, 3, 17)


def test_user_features_goldens(spark):
    b = clean.clean_banner_events(X.banners(spark))
    users = clean.parse_users(X.users_raw(spark))
    f = {r.user_id: r for r in features.user_features_7d(b, X.actions(spark), users, "2025-02-03").collect()}
    got = {u: (r.impressions_7d, r.clicks_7d, r.recency_days, r.actions_7d) for u, r in f.items()}
    assert got == {10: (3, 1, 2, 2), 11: (1, 0, 1, 2), 12: (1, 0, 2, 1)}
    assert f[10].segment == "high_spend" and f[12].segment is None


def test_users_deduplicated_and_blank_dates(spark):
    u = {r.user_id: r for r in clean.parse_users(X.users_raw(spark)).collect()}
    assert len(u) == 3
    assert u[12].date_create is None and u[12].date_end is None
    assert u[10].date_create == dt.date(2024, 1, 1)


@pytest.mark.parametrize("segment,p,expected", [
    ("high_spend", 0.1, "high_spend +20%"),
    (None, 0.5, "high_spend +20%"),
    ("low_active", 0.1, "low_active стандарт"),
    ("youth", 0.1, "стандарт"),
    (None, 0.1, "стандарт"),
    ("low_active", 0.7, "high_spend +20%"),
    ("high_active", 0.1, "high_spend +20%"),
    (" Low ", 0.2, "low_active стандарт"),
])
def test_recommend_bid(spark, segment, p, expected):
    df = spark.createDataFrame([(segment, p)], "segment string, probability_click double")
    assert df.select(C.recommend_bid()).collect()[0][0] == expected


@pytest.mark.parametrize("raw,clean", [
    ("placement (сайт/приложение/соцсеть)", "placement"),
    ("is_clicked (0/1)", "is_clicked"),
    ("source (баннер / органика / другое)", "source"),
    ("source (баннер/органика/другое)", "source"),
    ("User_id", "user_id"),
    ("﻿banner_id", "banner_id"),
    ("()", "col"),
])
def test_header_cleaning(raw, clean):
    assert clean_name(raw) == clean


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (5, 0)], "n bigint, d bigint")
    got = [r[0] for r in df.select(C.safe_ratio("n * 100", "d", 4)).collect()]
    assert got == [33.3333, 66.6667, 12.5, 0.0]
