"""Projection of the driver's parquet tables onto the campaign domain.

The test and benchmark inputs are generic tables (``events``, ``customer``,
``nation``, ``part``).  These functions map them, by fixed deterministic
rules, onto the lake's raw entities so that every job reads real tables and
its work grows with them.  Each Spark projection has a SQL twin (``SQL_*``)
with the same rules, used by the DuckDB oracle.

Rules (event_id = e, user = u):
* banner impressions: events of type view/click; banner = e % 100 + 1,
  campaign = e % 20 + 1, clicked = (type = click); placement by e % 3,
  device by (e div 15) % 2, os by (e div 30) % 2, geo by u % 5;
* dirt: user NULL when e % 97 = 0; an exact second copy with id 'e-dup' when
  e % 50 = 0;
* near copies (windowed de-dup only): e % 50 = 1 -> copy 4 minutes later,
  e % 50 = 2 -> copy 15 minutes later;
* installs: signup events, source by e % 3;
* actions: purchase/error events, action by e % 5 (one of them blank);
* users: customer; campaigns: nation (+1); banners: part (key % 100 + 1, so
  the banner dictionary has duplicates);
* dictionaries lack some keys (customer % 31 = 0, campaign 7, banner 13) and
  hold some rows twice (customer % 53 = 0, campaign 5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the domain (taken from the reference's message contract,
# dictionaries and simulator).
PLACEMENTS = ("site", "app", "social")
DEVICES = ("phone", "tablet")
OSES = ("ios", "android")
GEOS = ("Москва", "Санкт-Петербург", "Казань", "Самара", "Екатеринбург")
INSTALL_SOURCES = ("баннер", "органика", "другое")
ACTION_NAMES = ("first_order", "tarrif_switch", "registration", "", "other")
TARIFFS = ("basic", "standard", "premium", "unlimited")
CREATIVE_TYPES = ("static", "video", "rich")
BANNER_SIZES = ("300x250", "320x50", "1080x1920")
AUDIENCES = ("value", "youth", "family")
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(index: Column, values: tuple[str, ...]) -> Column:
    expr = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(index == i, F.lit(v))
    return expr


def sql_pick(index: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def _banner_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return (read_table(spark, sf_dir, "events")
            .filter(F.col("event_type").isin("view", "click"))
            .select(
                e.alias("eid"),
                e.cast("string").alias("event_id"),
                (e % 100 + 1).alias("banner_id"),
                (e % 20 + 1).alias("campaign_id"),
                F.when(e % 97 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
                F.col("ts").alias("event_ts"),
                pick(e % 3, PLACEMENTS).alias("placement"),
                pick(F.expr("(event_id div 15) % 2"), DEVICES).alias("device_type"),
                pick(F.expr("(event_id div 30) % 2"), OSES).alias("os"),
                pick(F.col("user_id") % 5, GEOS).alias("geo"),
                (F.col("event_type") == "click").cast("int").alias("is_clicked"),
            ))


_BANNER_COLUMNS = ["event_id", "banner_id", "campaign_id", "user_id", "event_ts", "event_date",
                   "placement", "device_type", "os", "geo", "is_clicked"]


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("event_ts")).select(*_BANNER_COLUMNS)


def _with_copies(base: DataFrame, near: bool) -> DataFrame:
    """One scan: each impression row is emitted once, plus its copies, via
    an exploded copy list (0 = original, 1 = exact copy, 2/3 = near copies)."""
    e = F.col("eid")
    kinds = [F.lit(0), F.when(e % 50 == 0, F.lit(1))]
    if near:
        kinds += [F.when(e % 50 == 1, F.lit(2)), F.when(e % 50 == 2, F.lit(3))]
    rows = base.withColumn("_copy", F.explode(F.array_compact(F.array(*kinds))))
    k = F.col("_copy")
    rows = rows.withColumn(
        "event_id", F.when(k == 0, F.col("event_id"))
        .when(k == 1, F.concat(F.col("event_id"), F.lit("-dup")))
        .otherwise(F.concat(F.col("event_id"), F.lit("-near"))))
    if near:
        rows = rows.withColumn(
            "event_ts", F.when(k == 2, F.col("event_ts") + F.expr("INTERVAL 4 MINUTES"))
            .when(k == 3, F.col("event_ts") + F.expr("INTERVAL 15 MINUTES"))
            .otherwise(F.col("event_ts")))
    return _finish(rows.drop("eid", "_copy"))


def raw_banner_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw impressions with the dirt described above (exact copies, NULL users)."""
    return _with_copies(_banner_base(spark, sf_dir), near=False)


def raw_banner_events_with_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_banner_events`` plus copies 4 and 15 minutes later (windowed de-dup input)."""
    return _with_copies(_banner_base(spark, sf_dir), near=True)


def raw_installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_table(spark, sf_dir, "events")
            .filter(F.col("event_type") == "signup")
            .select("user_id", F.col("ts").alias("install_timestamp"),
                    pick(F.col("event_id") % 3, INSTALL_SOURCES).alias("source")))


def raw_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_table(spark, sf_dir, "events")
            .filter(F.col("event_type").isin("purchase", "error"))
            .select("user_id", F.col("ts").alias("session_start"),
                    pick(F.col("event_id") % 5, ACTION_NAMES).alias("actions")))


def raw_cd_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dictionary as delivered: segment and tariff text, dates as text
    (some blank, some the word NULL)."""
    k = F.col("c_custkey")
    created = F.date_add(F.lit("2023-01-01").cast("date"), (k % 365).cast("int"))
    ended = F.date_add(F.lit("2024-06-01").cast("date"), (k % 30).cast("int"))
    return (read_table(spark, sf_dir, "customer").where(k % 31 != 0)
            .withColumn("_twice", F.explode(F.sequence(F.lit(0), F.when(k % 53 == 0, 1).otherwise(0))))
            .select(
                k.alias("user_id"),
                F.when(F.col("c_acctbal") > 5000, F.lit("high_spend"))
                 .when(F.col("c_acctbal") < 0, F.lit("low_active"))
                 .otherwise(F.lower("c_mktsegment")).alias("segment"),
                pick(F.col("c_nationkey") % 4, TARIFFS).alias("tariff"),
                F.date_format(created, "yyyy-MM-dd").alias("date_create"),
                F.when(k % 4 == 0, F.date_format(ended, "yyyy-MM-dd"))
                 .when(k % 4 == 1, F.lit(""))
                 .when(k % 4 == 2, F.lit("NULL"))
                 .otherwise(F.lit(" ")).alias("date_end"),
            ))


def raw_cd_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign dictionary as delivered: budget text with decimal comma on even
    keys (padded with spaces on every fifth), dates as dd.MM.yyyy text."""
    n = F.col("n_nationkey")
    whole = (F.lit(50000) + (n * 7919) % 150000).cast("string")
    cents = F.lpad(((n * 37) % 100).cast("string"), 2, "0")
    budget = F.concat(whole, F.when(n % 2 == 0, F.lit(",")).otherwise(F.lit(".")), cents)
    budget = F.when(n % 5 == 0, F.concat(F.lit(" "), budget, F.lit(" "))).otherwise(budget)
    start = F.date_add(F.lit("2024-01-01").cast("date"), (n % 5).cast("int"))
    end = F.date_add(F.lit("2024-03-01").cast("date"), (n % 7).cast("int"))
    return (read_table(spark, sf_dir, "nation").where(n != 6)
            .withColumn("_twice", F.explode(F.sequence(F.lit(0), F.when(n == 4, 1).otherwise(0))))
            .select((n + 1).cast("bigint").alias("campaign_id"), budget.alias("daily_budget"),
                    F.date_format(start, "dd.MM.yyyy").alias("start_date"),
                    F.date_format(end, "dd.MM.yyyy").alias("end_date")))


def raw_cd_banner(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return (read_table(spark, sf_dir, "part").where(k % 100 != 12)
            .select((k % 100 + 1).alias("banner_id"),
                    pick(F.col("p_size") % 3, CREATIVE_TYPES).alias("creative_type"),
                    F.col("p_name").alias("message"),
                    pick(k % 3, BANNER_SIZES).alias("size"),
                    pick(F.expr("(p_partkey div 100) % 3"), AUDIENCES).alias("target_audience_segment")))


# ---------------------------------------------------------------------------
# SQL twins (DuckDB dialect) of the projections above.

def _sql_banner_select(id_expr: str, ts_expr: str, where: str) -> str:
    return (
        f"SELECT {id_expr} AS event_id, event_id % 100 + 1 AS banner_id, "
        f"event_id % 20 + 1 AS campaign_id, "
        f"CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id, "
        f"{ts_expr} AS event_ts, CAST({ts_expr} AS DATE) AS event_date, "
        f"{sql_pick('event_id % 3', PLACEMENTS)} AS placement, "
        f"{sql_pick('(event_id // 15) % 2', DEVICES)} AS device_type, "
        f"{sql_pick('(event_id // 30) % 2', OSES)} AS os, "
        f"{sql_pick('user_id % 5', GEOS)} AS geo, "
        f"CAST(event_type = 'click' AS INTEGER) AS is_clicked "
        f"FROM events WHERE event_type IN ('view', 'click'){where}"
    )


SQL_RAW_BANNER_EVENTS = (
    _sql_banner_select("CAST(event_id AS VARCHAR)", "ts", "")
    + " UNION ALL "
    + _sql_banner_select("CAST(event_id AS VARCHAR) || '-dup'", "ts", " AND event_id % 50 = 0")
)

SQL_RAW_BANNER_EVENTS_NEAR = (
    SQL_RAW_BANNER_EVENTS
    + " UNION ALL "
    + _sql_banner_select("CAST(event_id AS VARCHAR) || '-near'", "(ts + INTERVAL 4 MINUTE)",
                         " AND event_id % 50 = 1")
    + " UNION ALL "
    + _sql_banner_select("CAST(event_id AS VARCHAR) || '-near'", "(ts + INTERVAL 15 MINUTE)",
                         " AND event_id % 50 = 2")
)

SQL_RAW_INSTALLS = (
    f"SELECT user_id, ts AS install_timestamp, {sql_pick('event_id % 3', INSTALL_SOURCES)} AS source "
    f"FROM events WHERE event_type = 'signup'"
)

SQL_RAW_ACTIONS = (
    f"SELECT user_id, ts AS session_start, {sql_pick('event_id % 5', ACTION_NAMES)} AS actions "
    f"FROM events WHERE event_type IN ('purchase', 'error')"
)

SQL_RAW_CD_USER = (
    "SELECT c_custkey AS user_id, "
    "CASE WHEN c_acctbal > 5000 THEN 'high_spend' WHEN c_acctbal < 0 THEN 'low_active' "
    "ELSE lower(c_mktsegment) END AS segment, "
    f"{sql_pick('c_nationkey % 4', TARIFFS)} AS tariff, "
    "strftime(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') AS date_create, "
    "CASE c_custkey % 4 WHEN 0 THEN strftime(DATE '2024-06-01' + CAST(c_custkey % 30 AS INTEGER), '%Y-%m-%d') "
    "WHEN 1 THEN '' WHEN 2 THEN 'NULL' ELSE ' ' END AS date_end "
    "FROM customer, range(2) AS copy(c) WHERE c_custkey % 31 <> 0 AND (c = 0 OR c_custkey % 53 = 0)"
)

SQL_RAW_CD_CAMPAIGN = (
    "SELECT CAST(n_nationkey + 1 AS BIGINT) AS campaign_id, "
    "CASE WHEN n_nationkey % 5 = 0 THEN ' ' || b || ' ' ELSE b END AS daily_budget, "
    "strftime(DATE '2024-01-01' + CAST(n_nationkey % 5 AS INTEGER), '%d.%m.%Y') AS start_date, "
    "strftime(DATE '2024-03-01' + CAST(n_nationkey % 7 AS INTEGER), '%d.%m.%Y') AS end_date "
    "FROM (SELECT *, CAST(50000 + (n_nationkey * 7919) % 150000 AS VARCHAR) "
    "|| CASE WHEN n_nationkey % 2 = 0 THEN ',' ELSE '.' END "
    "|| lpad(CAST((n_nationkey * 37) % 100 AS VARCHAR), 2, '0') AS b FROM nation) n, range(2) AS copy(c) "
    "WHERE n_nationkey <> 6 AND (c = 0 OR n_nationkey = 4)"
)

SQL_RAW_CD_BANNER = (
    "SELECT p_partkey % 100 + 1 AS banner_id, "
    f"{sql_pick('p_size % 3', CREATIVE_TYPES)} AS creative_type, p_name AS message, "
    f"{sql_pick('p_partkey % 3', BANNER_SIZES)} AS size, "
    f"{sql_pick('(p_partkey // 100) % 3', AUDIENCES)} AS target_audience_segment "
    "FROM part WHERE p_partkey % 100 <> 12"
)
