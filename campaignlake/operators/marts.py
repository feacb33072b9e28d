"""Campaign marts: daily campaign metrics, attribution and budget metrics.

Attribution is by *distinct exposure*: an install or action of a user on a
day counts for every campaign the user saw that day, once per campaign, no
matter how many impressions there were.  Both attribution inputs are first
reduced to one row per (user_id, date) -- distinct installers, summed action
revenue -- so the join with the exposure set is one-to-one on its key and
``count(*)`` equals ``count(DISTINCT user_id)`` without a distinct-aggregate
expansion.  Both reduced sides come out of their aggregate already hash
partitioned on (user_id, date), the join key.  The full mart folds installs
and actions into one such per-(user, date) aggregate and joins it once to
the per-(user, date, campaign) impression counts (``campaign_daily_full``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake import schemas
from campaignlake.functions import columns as C
from campaignlake.operators.clean import dedup_dimension

KEY = ["date", "campaign_id"]


# B22 -----------------------------------------------------------------------
def daily_banner_stats(banners: DataFrame) -> DataFrame:
    """(date, campaign_id) -> impressions = count(*), clicks = sum(is_clicked)."""
    return (banners.groupBy(F.to_date("event_ts").alias("date"), "campaign_id")
            .agg(F.count(F.lit(1)).alias("impressions"),
                 F.sum("is_clicked").cast("bigint").alias("clicks")))


# B23 -----------------------------------------------------------------------
def exposure_set(banners: DataFrame) -> DataFrame:
    """Distinct (user_id, date, campaign_id) of impressions with a user."""
    return (banners.filter(F.col("user_id").isNotNull())
            .select("user_id", F.to_date("event_ts").alias("date"), "campaign_id")
            .distinct())


# B24 -----------------------------------------------------------------------
def installers_by_day(installs: DataFrame) -> DataFrame:
    return (installs.filter(F.col("user_id").isNotNull())
            .select("user_id", F.to_date("install_timestamp").alias("date"))
            .distinct())


def attribute_installs(installs: DataFrame, exposure: DataFrame) -> DataFrame:
    """(date, campaign_id) -> installs = distinct users who installed on a day
    they saw the campaign."""
    return (exposure.join(installers_by_day(installs), ["user_id", "date"])
            .groupBy(*KEY).agg(F.count(F.lit(1)).alias("installs")))


# B25 -----------------------------------------------------------------------
def action_revenue_by_day(actions: DataFrame) -> DataFrame:
    """Non-blank actions reduced to (user_id, date) -> summed revenue weight."""
    return (actions.filter(F.col("user_id").isNotNull() & ~C.is_blank("actions"))
            .groupBy("user_id", F.to_date("session_start").alias("date"))
            .agg(F.sum(C.action_revenue("actions")).cast("bigint").alias("revenue")))


def attribute_actions(actions: DataFrame, exposure: DataFrame) -> DataFrame:
    """(date, campaign_id) -> conversions = distinct acting users, revenue =
    their summed action weights (first_order 100, tarrif_switch 50,
    registration 10, other 0)."""
    return (exposure.join(action_revenue_by_day(actions), ["user_id", "date"])
            .groupBy(*KEY).agg(F.count(F.lit(1)).alias("conversions"),
                               F.sum("revenue").cast("bigint").alias("revenue")))


# B29 -----------------------------------------------------------------------
def reject_null_keys(df: DataFrame, keys=("date", "campaign_id")) -> DataFrame:
    """Mart rows need every key column."""
    return df.dropna(subset=list(keys))


def _processing_date(processing_date: str | None):
    return F.lit(processing_date).cast("date") if processing_date else F.current_date()


# B26 -----------------------------------------------------------------------
def exposure_counts(banners: DataFrame) -> DataFrame:
    """(user_id, date, campaign_id) -> impressions, clicks.  Both the daily
    stats (summed over users) and the exposure set (its keys) come from this
    one aggregate, so the impressions are read and shuffled once."""
    return (banners.groupBy("user_id", F.to_date("event_ts").alias("date"), "campaign_id")
            .agg(F.count(F.lit(1)).alias("impressions"),
                 F.sum("is_clicked").cast("bigint").alias("clicks")))


_METRICS = ("impressions", "clicks", "installs", "conversions", "revenue")


def _finish_mart(summed: DataFrame, processing_date: str | None) -> DataFrame:
    """Zero-fill the metrics of a one-row-per-key frame, then the ratios."""
    filled = summed.select(
        F.col("campaign_id").cast("bigint").alias("campaign_id"), "date",
        *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in _METRICS])
    return filled.select(
        "campaign_id", "date", "impressions", "clicks",
        C.safe_ratio("clicks * 100", "impressions", 4).alias("ctr"),
        "installs", "conversions",
        F.col("revenue").cast("double").alias("revenue"),
        C.safe_ratio("revenue", "clicks", 2).alias("cpc"),
        C.safe_ratio("revenue * 1000", "impressions", 2).alias("cpm"),
        C.safe_ratio("installs * 100", "clicks", 4).alias("conversion_rate"),
        _processing_date(processing_date).alias("processing_date"),
    ).select(*schemas.MART_COLUMNS)


def user_day_outcomes(installs: DataFrame | None, actions: DataFrame | None) -> DataFrame:
    """(user_id, date) -> installed (0/1), converted (0/1), revenue: installs
    and non-blank actions folded into one aggregate (combined map-side)."""
    parts = []
    if installs is not None:
        parts.append(installs.filter(F.col("user_id").isNotNull()).select(
            "user_id", F.to_date("install_timestamp").alias("date"), F.lit(1).alias("installed"),
            F.lit(0).alias("converted"), F.lit(None).cast("bigint").alias("revenue")))
    if actions is not None:
        parts.append(actions.filter(F.col("user_id").isNotNull() & ~C.is_blank("actions")).select(
            "user_id", F.to_date("session_start").alias("date"), F.lit(0).alias("installed"),
            F.lit(1).alias("converted"), C.action_revenue("actions").cast("bigint").alias("revenue")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy("user_id", "date").agg(F.max("installed").alias("installed"),
                                               F.max("converted").alias("converted"),
                                               F.sum("revenue").alias("revenue"))


def campaign_daily_full(banners: DataFrame, installs: DataFrame | None = None,
                        actions: DataFrame | None = None,
                        processing_date: str | None = None) -> DataFrame:
    """The daily campaign mart from cleaned impressions, installs and actions.
    Installs and actions are optional; absent inputs give zeros.

    One pass: the (user, date, campaign) impression counts are left-joined
    to the per-(user, date) outcomes and summed per (date, campaign).  Each
    counts row is one exposure, so summing the outcome flags over them is
    the distinct-exposure attribution, and impressions/clicks come from the
    same rows; the de-duplicated impressions are shuffled and aggregated
    once.  Every attributed key has an impression, so this equals the full
    outer combination of B22, B24 and B25."""
    counts = exposure_counts(banners)
    if installs is None and actions is None:
        joined = counts.select("*", *[F.lit(None).cast("bigint").alias(c)
                                      for c in ("installed", "converted", "revenue")])
    else:
        joined = counts.join(user_day_outcomes(installs, actions), ["user_id", "date"], "left")
    summed = reject_null_keys(joined).groupBy(*KEY).agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("installed").alias("installs"), F.sum("converted").alias("conversions"),
        F.sum("revenue").alias("revenue"))
    return _finish_mart(summed, processing_date)


# B27 -----------------------------------------------------------------------
def campaign_daily_lite(banners: DataFrame, processing_date: str | None = None) -> DataFrame:
    """Impressions, clicks and ctr as an unrounded *fraction*; the other
    metrics are constant zero.  Kept apart from the full mart (other unit)."""
    date = F.col("event_date") if "event_date" in banners.columns else F.to_date("event_ts")
    agg = (banners.groupBy("campaign_id", date.alias("date"))
           .agg(F.count(F.lit(1)).alias("impressions"),
                F.coalesce(F.sum("is_clicked"), F.lit(0)).cast("bigint").alias("clicks")))
    fraction = F.when(F.col("impressions") > 0, F.col("clicks") / F.col("impressions")).otherwise(F.lit(0.0))
    absent = agg.withColumns({m: F.lit(0) for m in _METRICS if m not in agg.columns})
    return _finish_mart(absent, processing_date).withColumn("ctr", fraction).select(*schemas.MART_COLUMNS)


# B21 -----------------------------------------------------------------------
def campaign_budget_metrics(banners: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Lifetime impressions/clicks per campaign on the parsed campaign
    dictionary: calculated_cpm = budget*1000/impressions, calculated_cpc =
    budget/clicks, 0 when the divisor is 0 (unrounded doubles)."""
    stats = (banners.groupBy("campaign_id")
             .agg(F.count(F.lit(1)).alias("impressions"),
                  F.sum("is_clicked").cast("bigint").alias("clicks")))
    camp = dedup_dimension(campaigns, ["campaign_id"])
    j = camp.join(stats, "campaign_id", "left").select(
        "campaign_id", "daily_budget", "start_date", "end_date",
        F.coalesce("impressions", F.lit(0)).cast("bigint").alias("impressions"),
        F.coalesce("clicks", F.lit(0)).cast("bigint").alias("clicks"))
    return j.select(
        "*",
        F.when(F.col("impressions") > 0, F.col("daily_budget") * 1000 / F.col("impressions"))
         .otherwise(F.lit(0.0)).alias("calculated_cpm"),
        F.when(F.col("clicks") > 0, F.col("daily_budget") / F.col("clicks"))
         .otherwise(F.lit(0.0)).alias("calculated_cpc"),
    )


# B28 -----------------------------------------------------------------------
def upsert_rows(existing: DataFrame, updates: DataFrame, key=("date", "campaign_id")) -> DataFrame:
    """Existing rows whose key is not in the update, plus every update row
    (INSERT ... ON CONFLICT (key) DO UPDATE).  ``existing`` holds the touched
    partitions only (``lifecycle.upsert_table`` filters them)."""
    kept = existing.join(updates.select(*key), list(key), "left_anti")
    return kept.select(*existing.columns).unionByName(updates.select(*existing.columns))
