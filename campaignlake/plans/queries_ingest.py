"""Ingest queries (B01-B10, B18, B20, B29): deliveries are rendered from the
driver tables into the scratch folder, then read back by the ingest jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaignlake import schemas
from campaignlake.operators import clean, marts
from campaignlake.plans import oracle_sql as O
from campaignlake.plans.registry import ORACLE, PROCESSING_DATE, register
from campaignlake.session import new_scratch
from campaignlake.sources import deliveries as V
from campaignlake.sources import delimited, messages
from campaignlake.sources import domain as D

_N = V.sql_event_number()
_TS_TEXT = "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f')"
_BANNER_COLS = ("banner_id", "campaign_id", "user_id", "event_ts", "placement", "device_type",
                "os", "geo", "is_clicked")


def _banner_file(spark, sf, malformed=False):
    path = new_scratch(spark, "delivery-banners")
    lines = V.banner_lines(D.raw_banner_events(spark, sf), malformed=malformed)
    return V.write_lines(lines, V.BANNER_HEADER, path)


@register("ingest_delimited", f"WITH raw_b AS ({D.SQL_RAW_BANNER_EVENTS}) SELECT {O.event_identity()} "
          "AS event_id, banner_id, campaign_id, user_id, event_ts, placement, device_type, os, geo, "
          "is_clicked, event_date FROM raw_b")
def q_ingest_delimited(spark, sf):
    """Headered ';' file with bracketed Russian headers -> clean names ->
    typed entity -> generated event id and event_date."""
    df = delimited.ingest_delimited(spark, _banner_file(spark, sf), schemas.BANNER_EVENTS)
    return clean.add_event_identity(df).withColumn("event_date", F.to_date("event_ts"))


_MALFORMED = (f"WITH raw_b AS ({D.SQL_RAW_BANNER_EVENTS}), m AS (SELECT *, {_N} AS n FROM raw_b) ")


@register("split_malformed", _MALFORMED + "SELECT banner_id, campaign_id, user_id, event_ts, placement, "
          "device_type, os, geo, CASE WHEN n % 41 = 0 THEN NULL ELSE is_clicked END AS is_clicked FROM m "
          "WHERE n % 37 <> 0 AND n % 43 <> 0")
def q_split_malformed(spark, sf):
    good, _ = _split(spark, sf)
    return delimited.conform_entity(good, schemas.BANNER_EVENTS).drop("event_id")


def _split(spark, sf):
    schema = ", ".join(f"{c} string" for c in ("banner_id", "campaign_id", "user_id", "timestamp",
                                                "placement", "device_type", "os", "geo", "is_clicked"))
    df = delimited.read_delimited(spark, _banner_file(spark, sf, malformed=True), schema=schema)
    return delimited.split_malformed(df)


def _line_sql(fields: list[str]) -> str:
    return "concat_ws(';', " + ", ".join(fields) + ")"


_TXT = [f"COALESCE(CAST({c} AS VARCHAR), '')" for c in ("banner_id", "campaign_id", "user_id")] + \
    [f"COALESCE({_TS_TEXT}, '')"] + [f"COALESCE(CAST({c} AS VARCHAR), '')"
                                     for c in ("placement", "device_type", "os", "geo")]
_FLAG = "COALESCE(CAST(is_clicked AS VARCHAR), '')"


_RAW_TXT = ["CAST(banner_id AS VARCHAR)", "CAST(campaign_id AS VARCHAR)", "CAST(user_id AS VARCHAR)",
            _TS_TEXT, "placement", "device_type", "os"]


@register("quarantine_rows", _MALFORMED + "SELECT " + ", ".join(
    f"{e} AS {c}" for e, c in zip(_RAW_TXT, ("banner_id", "campaign_id", "user_id", "timestamp",
                                            "placement", "device_type", "os")))
    + ", CASE WHEN n % 37 = 0 THEN NULL ELSE geo END AS geo, "
    "CASE WHEN n % 37 = 0 THEN NULL ELSE CAST(is_clicked AS VARCHAR) END AS is_clicked, "
    f"CASE WHEN n % 37 = 0 THEN {_line_sql(_TXT[:7])} "
    f"ELSE {_line_sql(_TXT + [_FLAG, chr(39) + 'extra' + chr(39)])} END AS raw_line FROM m "
    "WHERE n % 37 = 0 OR n % 43 = 0")
def q_quarantine_rows(spark, sf):
    _, bad = _split(spark, sf)
    return bad


def _decoded_sql() -> str:
    z = "n % 89 = 0"
    ts = (f"CASE WHEN {z} THEN NULL WHEN n % 83 = 0 THEN date_trunc('second', event_ts) "
          "WHEN n % 79 = 0 THEN NULL ELSE date_trunc('second', event_ts) END")
    return (
        f"WITH raw_b AS ({D.SQL_RAW_BANNER_EVENTS}), m AS (SELECT *, {_N} AS n FROM raw_b), "
        "d AS (SELECT "
        f"CASE WHEN {z} THEN NULL ELSE event_id END AS event_id, "
        f"CASE WHEN {z} THEN NULL ELSE banner_id END AS banner_id, "
        f"CASE WHEN {z} OR n % 83 = 0 THEN NULL ELSE campaign_id END AS campaign_id, "
        f"CASE WHEN {z} THEN NULL ELSE user_id END AS user_id, "
        f"{ts} AS event_ts, "
        + ", ".join(f"CASE WHEN {z} THEN NULL ELSE {c} END AS {c}"
                    for c in ("placement", "device_type", "os", "geo", "is_clicked"))
        + f", CAST({ts} AS DATE) AS event_date FROM m) "
    )


@register("decode_events", _decoded_sql() + "SELECT * FROM d")
def q_decode_events(spark, sf):
    return messages.decode_events(_messages(spark, sf))


def _messages(spark, sf):
    path = V.write_messages(V.banner_messages(D.raw_banner_events(spark, sf)),
                            new_scratch(spark, "delivery-messages"))
    return messages.read_messages(spark, path, fmt="text")


@register("reject_null_keys", _decoded_sql() + "SELECT CAST(event_ts AS DATE) AS date, campaign_id, "
          "COUNT(*) AS impressions, CAST(SUM(is_clicked) AS BIGINT) AS clicks FROM d "
          "GROUP BY 1, 2 HAVING CAST(event_ts AS DATE) IS NOT NULL AND campaign_id IS NOT NULL")
def q_reject_null_keys(spark, sf):
    """Daily stats of decoded messages: malformed ones carry NULL keys."""
    decoded = messages.decode_events(_messages(spark, sf))
    return marts.reject_null_keys(marts.daily_banner_stats(decoded))


DEMO_ROWS = 1000


@register("take_first_n", f"WITH raw_b AS ({D.SQL_RAW_BANNER_EVENTS}) SELECT * FROM raw_b "
          f"ORDER BY event_id LIMIT {DEMO_ROWS}")
def q_take_first_n(spark, sf):
    """Demo-load row cap, repeatable order; below the rows of every test table
    but the smallest."""
    return delimited.take_first_n(D.raw_banner_events(spark, sf), DEMO_ROWS, ["event_id"])


@register("csv_flow_mart", O.full_mart())
def q_csv_flow_mart(spark, sf):
    """P2: delimited delivery -> raw -> operational layer -> full mart."""
    from campaignlake.plans.flows import csv_flow
    root = new_scratch(spark, "delivery")
    V.write_delimited_delivery(spark, sf, root)
    return csv_flow(spark, root, new_scratch(spark, "lake"), processing_date=PROCESSING_DATE)


@register("csv_flow_two_deliveries", O.full_mart())
def q_csv_flow_two_deliveries(spark, sf):
    """P2 in two deliveries, the second with late rows of the first's days,
    then the first one once more: the same mart as from one delivery."""
    from campaignlake.plans.flows import csv_flow
    root, lake = new_scratch(spark, "delivery"), new_scratch(spark, "lake")
    for part in (1, 2):
        V.write_delimited_delivery(spark, sf, f"{root}/day-{part}", part)
    csv_flow(spark, f"{root}/day-1", lake, PROCESSING_DATE)
    csv_flow(spark, f"{root}/day-2", lake, PROCESSING_DATE)
    return csv_flow(spark, f"{root}/day-1", lake, PROCESSING_DATE)


def _first_delivery(rows: str, ts: str) -> str:
    late = f"COALESCE(user_id, 1) % {V.LATE_USERS} = 0 OR second({ts}) % {V.LATE_USERS} = 0"
    return f"SELECT * FROM {rows} WHERE {ts} < TIMESTAMP '{V.FIRST_DELIVERY_BEFORE}' AND NOT ({late})"


@register("csv_flow_corrected", f"WITH {O.base_ctes()}, b1 AS ({_first_delivery('b', 'event_ts')}), "
          f"i1 AS ({_first_delivery('i', 'install_timestamp')}), a1 AS ({_first_delivery('a', 'session_start')}), "
          f"{O.mart_ctes('b1', 'i1', 'a1')} {O.mart_select('c', PROCESSING_DATE)}")
def q_csv_flow_corrected(spark, sf):
    """P2 on a delivery with every day and bad lines, then on the same delivery
    corrected, with fewer rows and days: the mart of the corrected one alone."""
    from campaignlake.plans.flows import csv_flow
    root, lake = new_scratch(spark, "delivery"), new_scratch(spark, "lake")
    for version, part in (("sent", None), ("corrected", 1)):
        V.write_delimited_delivery(spark, sf, f"{root}/{version}", part, malformed=part is None)
        mart = csv_flow(spark, f"{root}/{version}", lake, PROCESSING_DATE, "day-1")
    return mart


@register("csv_flow_quarantine", ORACLE["quarantine_rows"])
def q_csv_flow_quarantine(spark, sf):
    """P2 on a delivery with bad lines: what the flow set aside."""
    from campaignlake.plans.flows import csv_flow
    root, lake = new_scratch(spark, "delivery"), new_scratch(spark, "lake")
    V.write_delimited_delivery(spark, sf, root, malformed=True)
    csv_flow(spark, root, lake, PROCESSING_DATE)
    return spark.read.parquet(f"{lake}/quarantine/banner_events").drop("delivery")
