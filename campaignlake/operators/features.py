"""Seven-day user features for the click model.

Window: event date in the half-open range [snapshot - days, snapshot).  The
range is applied to the partition column ``event_date`` when the input has
it (partition pruning) and to ``event_ts`` (row-group pushdown); both say
the same thing because event_date = to_date(event_ts).
Everything is one grouped aggregate per user (combined map-side) followed by
one-to-one left joins on user_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake import schemas


def _window_filter(df: DataFrame, ts: str, snapshot_date: str, days: int,
                   date_col: str | None = None) -> DataFrame:
    snap = F.lit(snapshot_date).cast("date")
    start = F.date_sub(snap, days)
    ts_type = df.schema[ts].dataType.simpleString()
    cond = (F.col(ts) >= start.cast(ts_type)) & (F.col(ts) < snap.cast(ts_type))
    if date_col and date_col in df.columns:
        cond = cond & (F.col(date_col) >= start) & (F.col(date_col) < snap)
    return df.filter(cond)


# B30 -----------------------------------------------------------------------
def user_activity_7d(banners: DataFrame, snapshot_date: str, days: int = 7,
                     latest: bool = False) -> DataFrame:
    """Per user over the window: impressions_7d, clicks_7d, recency_days (days
    from the last impression date to the snapshot), device_type and os.

    device_type/os are the lexicographic ``max`` (as the reference code does);
    ``latest=True`` takes the value of the latest impression instead
    (ties broken by event_id)."""
    w = _window_filter(banners, "event_ts", snapshot_date, days, "event_date")
    if latest:
        order = F.struct("event_ts", "event_id")
        dev, os_ = F.max_by("device_type", order), F.max_by("os", order)
    else:
        dev, os_ = F.max("device_type"), F.max("os")
    agg = w.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("impressions_7d"),
        F.sum("is_clicked").cast("bigint").alias("clicks_7d"),
        F.max("event_ts").alias("_last_ts"),
        dev.alias("device_type"), os_.alias("os"))
    snap = F.lit(snapshot_date).cast("date")
    return agg.select(
        "user_id", snap.alias("snapshot_date"), "impressions_7d", "clicks_7d",
        F.datediff(snap, F.to_date("_last_ts")).cast("int").alias("recency_days"),
        "device_type", "os")


def actions_7d(actions: DataFrame, snapshot_date: str, days: int = 7) -> DataFrame:
    """Per user: all actions in the window (blank ones included)."""
    w = _window_filter(actions, "session_start", snapshot_date, days)
    return w.groupBy("user_id").agg(F.count(F.lit(1)).alias("actions_7d"))


# B31 -----------------------------------------------------------------------
def enrich_user_features(activity: DataFrame, actions: DataFrame | None,
                         users: DataFrame | None, snapshot_date: str,
                         days: int = 7) -> DataFrame:
    """actions_7d (0 when none), segment and tariff (NULL when unknown).
    ``users`` must be one row per user_id (see ``clean.parse_users``)."""
    out = activity
    if actions is not None:
        out = out.join(actions_7d(actions, snapshot_date, days), "user_id", "left")
    else:
        out = out.withColumn("actions_7d", F.lit(None).cast("bigint"))
    out = out.withColumn("actions_7d", F.coalesce("actions_7d", F.lit(0)).cast("bigint"))
    if users is not None:
        out = out.join(users.select("user_id", "segment", "tariff"), "user_id", "left")
    else:
        out = (out.withColumn("segment", F.lit(None).cast("string"))
               .withColumn("tariff", F.lit(None).cast("string")))
    return out.select(*schemas.FEATURE_COLUMNS)


def user_features_7d(banners: DataFrame, actions: DataFrame | None, users: DataFrame | None,
                     snapshot_date: str, days: int = 7, latest: bool = False) -> DataFrame:
    """B30 + B31: the ml.user_features slice of one snapshot date."""
    return enrich_user_features(user_activity_7d(banners, snapshot_date, days, latest),
                                actions, users, snapshot_date, days)
