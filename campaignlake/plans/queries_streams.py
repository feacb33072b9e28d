"""Change-data, streaming, lifecycle and flow queries (B28, B40, B45-B52,
P1, P3).  Streams run with ``availableNow`` over deliveries written to the
scratch folder; the result table is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake import schemas
from campaignlake.operators import clean, lifecycle, marts
from campaignlake.plans import oracle_sql as O
from campaignlake.plans.queries_core import ods_banners
from campaignlake.plans.queries_ingest import _decoded_sql
from campaignlake.plans.queries_ml import _FEATURE_CTES, _BID_SQL, q_recommend_bid
from campaignlake.plans.registry import PROCESSING_DATE, SNAPSHOT_DATE, register
from campaignlake.session import list_files, new_scratch, rename_path
from campaignlake.sources import deliveries as V
from campaignlake.sources import domain as D
from campaignlake.streaming import changes, events

_EV = ("ev AS (SELECT event_id AS n, user_id, ts, "
       + D.sql_pick("event_id % 5", D.ACTION_NAMES)
       + " AS actions, '{\"id\":' || CAST(event_id AS VARCHAR) || '}' AS key FROM events "
       "WHERE event_type IN ('purchase', 'error'))")

_CREATED = ("SELECT key, user_id, ts AS session_start, actions, 'c' AS op, (epoch_us(ts) // 1000) AS ts_ms, "
            "CASE WHEN n % 13 = 0 THEN '{\"channel\":\"app\"}' END AS extra_fields")
_UPDATED = ("SELECT key, user_id, ts AS session_start, 'registration' AS actions, 'u' AS op, "
            "(epoch_us(ts) // 1000) + 1000 AS ts_ms, CAST(NULL AS VARCHAR) AS extra_fields")


def _feed(spark, sf):
    return V.write_change_feed(V.action_change_feed(spark, sf), new_scratch(spark, "delivery-feed"))


def _forms(spark, sf):
    path = V.write_change_feed(V.action_change_forms(spark, sf), new_scratch(spark, "delivery-feed"))
    return changes.read_feed(spark, path)


# rows unwrapped at the source: microseconds keep the whole time, milliseconds cut it
_FLAT = ("SELECT key, user_id, CASE WHEN n % 2 = 0 THEN ts ELSE date_trunc('milliseconds', ts) END AS session_start, "
         "actions, CAST(NULL AS VARCHAR) AS op, (epoch_us(ts) // 1000) AS ts_ms, CAST(NULL AS VARCHAR) AS extra_fields")


@register("unwrap_changes", f"WITH {_EV} {_CREATED}, false AS is_tombstone FROM ev UNION ALL "
          f"{_UPDATED}, false FROM ev WHERE n % 7 = 0 UNION ALL SELECT key, NULL, NULL, NULL, NULL, "
          "NULL, NULL, true FROM ev WHERE n % 11 = 0 "
          f"UNION ALL {_FLAT}, false FROM ev WHERE n % 17 = 0 AND n % 34 <> 17")
def q_unwrap_changes(spark, sf):
    """Envelopes, unwrapped rows with both time encodings, deletes, tombstones
    and messages that are no change record."""
    return changes.unwrap_changes(_forms(spark, sf))


@register("unwrap_quarantine", f"WITH {_EV} SELECT key, 'not json ' || CAST(n AS VARCHAR) AS raw_value FROM ev "
          "WHERE n % 19 = 0 UNION ALL SELECT key, '{\"other\":' || CAST(n AS VARCHAR) || '}' FROM ev WHERE n % 23 = 0")
def q_unwrap_quarantine(spark, sf):
    return changes.quarantined_changes(_forms(spark, sf))


@register("route_topics", f"WITH {_EV} SELECT key, 0 AS seq, 'raw_actions' AS topic, (epoch_us(ts) // 1000) AS ts_ms "
          "FROM ev UNION ALL SELECT key, 1, 'raw_actions', (epoch_us(ts) // 1000) + 1000 FROM ev WHERE n % 7 = 0 "
          "UNION ALL SELECT key, 2, 'raw_actions', (epoch_us(ts) // 1000) + 2000 FROM ev WHERE n % 11 = 0 "
          "UNION ALL SELECT key, 3, 'raw_actions', (epoch_us(ts) // 1000) + 2001 FROM ev WHERE n % 11 = 0")
def q_route_topics(spark, sf):
    return changes.route_topics(V.action_change_feed(spark, sf)).select("key", "seq", "topic", "ts_ms")


def _appended(spark, sf):
    table = new_scratch(spark, "ods-fct-actions")
    changes.append_stream_to_table(spark, _feed(spark, sf), table)
    return changes.read_appended(spark, table)


@register("append_stream_to_table", f"WITH {_EV} {_CREATED} FROM ev UNION ALL {_UPDATED} FROM ev "
          "WHERE n % 7 = 0")
def q_append_stream_to_table(spark, sf):
    return _appended(spark, sf)


@register("append_stream_latest", f"WITH {_EV} {_CREATED} FROM ev WHERE n % 7 <> 0 UNION ALL "
          f"{_UPDATED} FROM ev WHERE n % 7 = 0")
def q_append_stream_latest(spark, sf):
    return changes.latest_rows(_appended(spark, sf), ["key"], "ts_ms")


def _message_folder(spark, sf, near=False):
    raw = D.raw_banner_events_with_near_copies(spark, sf) if near else D.raw_banner_events(spark, sf)
    return V.write_messages(V.banner_messages(raw), new_scratch(spark, "delivery-messages"))


_STREAM_COLS = ("banner_id", "campaign_id", "user_id", "event_ts", "placement", "device_type", "os",
                "geo", "is_clicked", "event_date")


@register("stream_banner_events", _decoded_sql() + f"SELECT DISTINCT {', '.join(_STREAM_COLS)} FROM d "
          "WHERE user_id IS NOT NULL AND event_ts IS NOT NULL")
def q_stream_banner_events(spark, sf):
    """Stream result compared without event_id: the first arrival survives."""
    table = new_scratch(spark, "ods-banner-stream")
    events.stream_banner_events(spark, _message_folder(spark, sf), table)
    return spark.read.parquet(table).select(*_STREAM_COLS)


@register("stream_compact_stream", _decoded_sql() + "SELECT banner_id, user_id, event_ts, event_date FROM d "
          "WHERE user_id IS NOT NULL AND event_ts IS NOT NULL GROUP BY ALL "
          "UNION ALL SELECT -1, -1, TIMESTAMP '2024-01-10 00:00:00', DATE '2024-01-10'")
def q_stream_compact_stream(spark, sf):
    """A table that holds a batch-written row; a stream appends the first
    messages, the table is compacted, the stream goes on."""
    table, feed, ckpt = (new_scratch(spark, x) for x in ("ods-banner-stream", "messages", "checkpoint-banners"))
    raw = D.raw_banner_events(spark, sf)
    seed = (raw.limit(1).withColumn("banner_id", F.lit(-1).cast("bigint")).withColumn("user_id", F.lit(-1).cast("bigint"))
            .withColumn("event_ts", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
            .withColumn("event_date", F.to_date("event_ts")))
    lifecycle.write_layer(seed, table, "event_date")
    early = F.col("event_ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    for part in (raw.where(early), raw.where(~early)):
        V.banner_messages(part).select("value").write.mode("append").text(feed)
        events.stream_banner_events(spark, feed, table, ckpt)
        lifecycle.compact_partitions(spark, table, "event_date")
    return spark.read.parquet(table).select("banner_id", "user_id", "event_ts", "event_date")


def _near_decoded_sql() -> str:
    return _decoded_sql().replace(D.SQL_RAW_BANNER_EVENTS, D.SQL_RAW_BANNER_EVENTS_NEAR, 1)


@register("stream_dedup_within_window", _near_decoded_sql() + ", w AS (SELECT *, lag(event_ts) OVER "
          "(PARTITION BY banner_id, user_id ORDER BY event_ts, event_id) AS prev FROM d "
          "WHERE user_id IS NOT NULL AND event_ts IS NOT NULL) SELECT * EXCLUDE (prev) FROM w "
          "WHERE prev IS NULL OR event_ts - prev >= INTERVAL 10 MINUTE")
def q_stream_dedup_within_window(spark, sf):
    table = new_scratch(spark, "ods-banner-window")
    events.stream_dedup_within_window(spark, _message_folder(spark, sf, near=True), table)
    return spark.read.parquet(table).select(*[c for c, _ in schemas.BANNER_EVENTS.columns], "event_date")


_LINE = ("concat_ws(';', COALESCE(CAST(user_id AS VARCHAR), ''), "
         "COALESCE(strftime(install_timestamp, '%Y-%m-%d %H:%M:%S.%f'), ''), COALESCE(source, ''))")


_SHIPPED_SQL = (f"WITH i AS ({D.SQL_RAW_INSTALLS}), l AS (SELECT {_LINE} AS line FROM i) "
                "SELECT 'filebeat-logs' AS topic, '{\"message\":\"' || line || '\",\"fields\":{\"log_type\":\"csv\"}}' "
                "AS value, line AS message FROM l")


@register("ship_lines", _SHIPPED_SQL)
def q_ship_lines(spark, sf):
    src = V.write_lines(V.installs_lines(D.raw_installs(spark, sf)), V.INSTALLS_HEADER,
                        new_scratch(spark, "delivery-installs"))
    table = new_scratch(spark, "log-messages")
    events.ship_lines(spark, src, table, skip_line=";".join(V.INSTALLS_HEADER))
    return spark.read.parquet(table).select("topic", "value", "message")


@register("ship_lines_growing", _SHIPPED_SQL)
def q_ship_lines_growing(spark, sf):
    """Files that grow between runs of the stream, with a last line that is not
    complete yet, and are then rotated: every line is shipped once."""
    lines = V.installs_lines(D.raw_installs(spark, sf))
    feed, table, ckpt = (new_scratch(spark, n) for n in ("growing-installs", "log-messages", "checkpoint-lines"))
    for turn, cut in enumerate((9, 0, 0)):
        part = lines.where(F.pmod(F.xxhash64("value", F.lit(1)), F.lit(3)) == turn)
        if turn == 2:
            for name in list_files(spark, feed, ".csv"):
                rename_path(spark, f"{feed}/{name}", f"{feed}/{name}.1")
        V.grow_files(part, V.INSTALLS_HEADER, feed, cut=cut)
        events.ship_lines(spark, feed, table, ckpt, skip_line=";".join(V.INSTALLS_HEADER), growing=True)
    return spark.read.parquet(table).select("topic", "value", "message")


# --- lifecycle ------------------------------------------------------------------

_SPLIT_OLD = "2024-01-16 12:00:00"
_SPLIT_NEW = "2024-01-14 00:00:00"


def _upsert_sql() -> str:
    def f(src, col, op, ts):
        return f"SELECT * FROM {src} WHERE {col} {op} TIMESTAMP '{ts}'"
    return (
        f"WITH {O.base_ctes()}, "
        f"b1 AS ({f('b', 'event_ts', '<', _SPLIT_OLD)}), i1 AS ({f('i', 'install_timestamp', '<', _SPLIT_OLD)}), "
        f"a1 AS ({f('a', 'session_start', '<', _SPLIT_OLD)}), "
        f"b2 AS ({f('b', 'event_ts', '>=', _SPLIT_NEW)}), i2 AS ({f('i', 'install_timestamp', '>=', _SPLIT_NEW)}), "
        f"a2 AS ({f('a', 'session_start', '>=', _SPLIT_NEW)}), "
        f"{O.mart_ctes('b1', 'i1', 'a1', 'x_')}, {O.mart_ctes('b2', 'i2', 'a2', 'y_')}, "
        f"ex AS ({O.mart_select('x_c', '2024-01-16')}), up AS ({O.mart_select('y_c', PROCESSING_DATE)}) "
        "SELECT * FROM ex WHERE NOT EXISTS (SELECT 1 FROM up WHERE up.date = ex.date "
        "AND up.campaign_id = ex.campaign_id) UNION ALL SELECT * FROM up"
    )


@register("upsert_by_key", _upsert_sql())
def q_upsert_by_key(spark, sf):
    """Mart of data before 2024-01-16 12:00, then upserted with the mart of
    data from 2024-01-14: overlapping days are replaced key by key."""
    b = ods_banners(spark, sf)
    i = clean.drop_null_key(D.raw_installs(spark, sf))
    a = clean.drop_null_key(D.raw_actions(spark, sf))

    def cut(df, col, older):
        ts = F.lit(_SPLIT_OLD if older else _SPLIT_NEW).cast("timestamp_ntz")
        return df.filter(F.col(col) < ts) if older else df.filter(F.col(col) >= ts)

    old = marts.campaign_daily_full(cut(b, "event_ts", True), cut(i, "install_timestamp", True),
                                    cut(a, "session_start", True), "2024-01-16")
    new = marts.campaign_daily_full(cut(b, "event_ts", False), cut(i, "install_timestamp", False),
                                    cut(a, "session_start", False), PROCESSING_DATE)
    table = lifecycle.write_layer(old, new_scratch(spark, "dm-campaign-daily"), "date")
    lifecycle.upsert_table(spark, table, new)
    return spark.read.parquet(table).select(*schemas.MART_COLUMNS)


_ODS_COLS = ["event_id", "banner_id", "campaign_id", "user_id", "event_ts", "event_date", "placement",
             "device_type", "os", "geo", "is_clicked"]


@register("write_layer", f"WITH {O.base_ctes()} SELECT * FROM b")
def q_write_layer(spark, sf):
    """ODS written partitioned by event_date, then one day rewritten from a
    frame holding only that day: dynamic overwrite leaves the other days."""
    path = lifecycle.write_layer(ods_banners(spark, sf), new_scratch(spark, "ods-layer"), "event_date")
    day = spark.read.parquet(path).filter(F.col("event_date") == F.lit("2024-01-10").cast("date"))
    lifecycle.write_layer(lifecycle.stage(day, "event_date"), path, "event_date")
    return spark.read.parquet(path).select(*_ODS_COLS)


@register("compact_partitions", f"WITH {O.base_ctes()} SELECT * FROM b")
def q_compact_partitions(spark, sf):
    """Many small files per day, then the days from 2024-01-10 compacted;
    the table's rows are unchanged."""
    table = lifecycle.write_layer(ods_banners(spark, sf).repartition(16), new_scratch(spark, "ods-banners"),
                                  "event_date", rebalance=False)
    lifecycle.compact_partitions(spark, table, "event_date", where="event_date >= DATE'2024-01-10'",
                                 rows_per_file=1000)
    return spark.read.parquet(table).select(*_ODS_COLS)


@register("compact_beside_append", f"WITH {O.base_ctes()} SELECT * FROM b")
def q_compact_beside_append(spark, sf):
    """Rows come into the same days after a compaction copied its files and
    before it puts the copies in place: all rows are there."""
    rows = ods_banners(spark, sf)
    late = F.pmod(V.event_number(), F.lit(3)) == 0
    table = lifecycle.write_layer(rows.where(~late).repartition(16), new_scratch(spark, "ods-banners"), "event_date",
                                  rebalance=False)
    lifecycle.copy_compacted(spark, table, "event_date", rows_per_file=1000)
    lifecycle.write_layer(rows.where(late), table, "event_date", mode="append")
    lifecycle.finish_compaction(spark, table)
    return spark.read.parquet(table).select(*_ODS_COLS)


_AS_OF = "2024-02-15"


@register("tier_hot_cold", f"WITH {O.base_ctes()} SELECT *, CASE WHEN event_date >= DATE '{_AS_OF}' - 30 "
          "THEN 'hot' ELSE 'cold' END AS tier FROM b")
def q_tier_hot_cold(spark, sf):
    """Tier, then rows of archived days come late into the hot table, then
    tier again: every row is in one of the two tables."""
    rows = ods_banners(spark, sf)
    late = F.pmod(V.event_number(), F.lit(7)) == 0
    hot = lifecycle.write_layer(rows.where(~late), new_scratch(spark, "ods-hot"), "event_date")
    cold = new_scratch(spark, "ods-cold")
    lifecycle.tier_hot_cold(spark, hot, cold, "event_date", as_of=_AS_OF, hot_days=30)
    rows.where(late).hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(hot)
    lifecycle.tier_hot_cold(spark, hot, cold, "event_date", as_of=_AS_OF, hot_days=30)
    h = spark.read.parquet(hot).select(*_ODS_COLS).withColumn("tier", F.lit("hot"))
    c = spark.read.parquet(cold).select(*_ODS_COLS).withColumn("tier", F.lit("cold"))
    return h.unionByName(c)


@register("write_predictions", f"WITH {_FEATURE_CTES}, r AS (SELECT user_id, snapshot_date, "
          "CASE WHEN impressions_7d > 0 THEN clicks_7d / impressions_7d ELSE 0.0 END AS p, segment, "
          "lower(trim(COALESCE(segment, 'default'))) AS s FROM f) "
          f"SELECT user_id, snapshot_date, p AS probability_click, segment, {_BID_SQL} AS recommend_bid FROM r")
def q_write_predictions(spark, sf):
    path = lifecycle.write_predictions(q_recommend_bid(spark, sf), new_scratch(spark, "ml-predictions"))
    return spark.read.parquet(path).select("user_id", "snapshot_date", "probability_click", "segment",
                                           "recommend_bid")


# --- flows ------------------------------------------------------------------------

_LITE_SQL = (
    _decoded_sql() + ", c AS (" + O.clean_banners("d") + ") SELECT CAST(campaign_id AS BIGINT) AS campaign_id, "
    "event_date AS date, COUNT(*) AS impressions, CAST(COALESCE(SUM(is_clicked), 0) AS BIGINT) AS clicks, "
    "COALESCE(SUM(is_clicked), 0) / COUNT(*) AS ctr, CAST(0 AS BIGINT) AS installs, "
    "CAST(0 AS BIGINT) AS conversions, 0.0::DOUBLE AS revenue, 0.0::DOUBLE AS cpc, 0.0::DOUBLE AS cpm, "
    f"0.0::DOUBLE AS conversion_rate, DATE '{PROCESSING_DATE}' AS processing_date FROM c "
    "GROUP BY campaign_id, event_date"
)


@register("banner_events_flow_mart", _LITE_SQL)
def q_banner_events_flow(spark, sf):
    """P1: messages -> raw -> ods -> lite mart."""
    from campaignlake.plans.flows import banner_events_flow
    return banner_events_flow(spark, _message_folder(spark, sf), new_scratch(spark, "lake"),
                              processing_date=PROCESSING_DATE)


@register("banner_events_flow_two_deliveries", _LITE_SQL)
def q_banner_events_flow_two(spark, sf):
    """P1 in two deliveries with late messages, then the first once more."""
    from campaignlake.plans.flows import banner_events_flow
    root, lake = new_scratch(spark, "delivery-messages"), new_scratch(spark, "lake")
    raw = D.raw_banner_events(spark, sf)
    for part in (1, 2):
        V.write_messages(V.banner_messages(V.delivered_in(raw, "event_ts", part)), f"{root}/day-{part}")
    for part in (1, 2, 1):
        mart = banner_events_flow(spark, f"{root}/day-{part}", lake, processing_date=PROCESSING_DATE)
    return mart


@register("ml_daily_features", f"WITH {_FEATURE_CTES} SELECT * FROM f")
def q_ml_daily_features(spark, sf):
    """P3: ods tables -> ml.user_features slice of the snapshot date."""
    from campaignlake.plans.flows import ml_daily_flow
    lake = new_scratch(spark, "lake")
    lifecycle.write_layer(ods_banners(spark, sf), f"{lake}/ods/banner_events", "event_date")
    lifecycle.write_layer(clean.drop_null_key(D.raw_actions(spark, sf)), f"{lake}/ods/fct_actions")
    lifecycle.write_layer(clean.parse_users(D.raw_cd_user(spark, sf)), f"{lake}/ods/cd_user")
    return ml_daily_flow(spark, lake, SNAPSHOT_DATE)
