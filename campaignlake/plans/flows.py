"""Composite flows: message flow (P1), delimited-file flow (P2) and daily
features (P3).  Each layer is written as a table and the next step reads it
back, so every step is restartable.  Raw rows are kept by delivery; the days
that a delivery touches are rebuilt from all deliveries."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake import schemas
from campaignlake.operators import clean, features, lifecycle, marts
from campaignlake.session import delete_path, path_exists, read_note, write_note
from campaignlake.sources import delimited, messages

DELIVERY_FILES = {
    "banner_events": "Fct_banners_show",
    "installs": "Installs",
    "fct_actions": "Fct_actions",
    "cd_banner": "CD_banner",
    "cd_campaign": "CD_campaign",
    "cd_user": "CD_user",
}
# Facts: partition column and the time it is the day of.
DAYS = {"banner_events": ("event_date", "event_ts"), "installs": ("install_date", "install_timestamp"),
        "fct_actions": ("session_date", "session_start")}
DELIVERY = "delivery"


def _layer(lake_root: str, layer: str, table: str) -> str:
    return f"{lake_root.rstrip('/')}/{layer}/{table}"


def _concurrently(jobs: dict[str, Callable[[], object]], max_workers: int = 6) -> dict[str, object]:
    """Submit independent Spark jobs (one per table) from a few threads so
    that small dictionary writes overlap the large fact write instead of
    queueing behind it.  Spark's scheduler shares the executors."""
    if len(jobs) <= 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        return {k: fut.result() for k, fut in futures.items()}


def _delivery_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _pending(lake_root: str, name: str, entity: str = "") -> str:
    """Journal of a delivery: the days of an entity that it touches."""
    return f"{_layer(lake_root, 'raw', '_pending')}/{name}/{entity}".rstrip("/")


def _touch(spark: SparkSession, table: str, name: str, day: str, journal: str) -> list:
    """Days that the delivery's stored rows are of, and those that an
    interrupted run noted; noted before its folder is removed."""
    folder = f"{table}/{DELIVERY}={name}"
    stored = lifecycle.read_table(spark, folder) if path_exists(spark, folder) else None
    days = set(lifecycle.partition_values(stored, day)) if stored is not None else set()
    for noted in read_note(spark, journal) or []:
        days.add(None if noted == "null" else dt.date.fromisoformat(noted))
    write_note(spark, journal, ["null" if d is None else str(d) for d in sorted(days, key=lambda d: (d is not None, d))])
    delete_path(spark, folder)
    return list(days)


def _days_of(spark: SparkSession, table: str, name: str, day: str, before: list) -> list:
    """``before`` and the days that the delivery's stored rows are of now."""
    stored = lifecycle.read_table(spark, f"{table}/{DELIVERY}={name}")
    now = lifecycle.partition_values(stored, day) if stored is not None else []
    return sorted({*before, *now}, key=lambda d: (d is not None, d))


def load_raw_delivery(spark: SparkSession, delivery_root: str, lake_root: str,
                      delivery: str | None = None) -> dict[str, list]:
    """B01-B04 for every delivered file present.  Raw tables are partitioned
    by ``delivery`` (default: the folder's name) and, for facts, by day: the
    same delivery again replaces its own rows only.  Lines with a wrong number
    of fields go to quarantine/<entity>.  Returns {entity: days that the
    delivery holds or held before} ([] for dictionaries)."""
    name = delivery or _delivery_name(delivery_root)

    def job(entity: str, src: str) -> Callable[[], list]:
        def run() -> list:
            good, bad = delimited.split_malformed(delimited.read_lines_checked(spark, src))
            out = _layer(lake_root, "raw", entity)
            quarantine = bad.withColumn(DELIVERY, F.lit(name))
            # a corrected delivery may have no such line: its folder goes first
            delete_path(spark, f"{_layer(lake_root, 'quarantine', entity)}/{DELIVERY}={name}")
            lifecycle.write_layer(quarantine, _layer(lake_root, "quarantine", entity), DELIVERY)
            df = delimited.conform_entity(good, schemas.ENTITIES[entity])
            if entity not in DAYS:
                lifecycle.write_layer(df.withColumn(DELIVERY, F.lit(name)), out, DELIVERY)
                return []
            day, ts = DAYS[entity]
            if entity == "banner_events":
                df = clean.add_event_identity(df)
            # the delivery may have held other days before: they count as touched
            before = _touch(spark, out, name, day, _pending(lake_root, name, entity))
            lifecycle.write_layer(df.withColumn(day, F.to_date(ts)).withColumn(DELIVERY, F.lit(name)), out, [DELIVERY, day])
            return _days_of(spark, out, name, day, before)
        return run

    jobs = {}
    for entity, fname in DELIVERY_FILES.items():
        src = f"{delivery_root.rstrip('/')}/{fname}"
        if path_exists(spark, src):
            jobs[entity] = job(entity, src)
    return _concurrently(jobs)  # type: ignore[return-value]


def _all_days(spark: SparkSession, lake_root: str) -> dict[str, list]:
    out = {}
    for entity in DELIVERY_FILES:
        t = lifecycle.read_table(spark, _layer(lake_root, "raw", entity))
        if t is not None:
            out[entity] = lifecycle.partition_values(t, DAYS[entity][0]) if entity in DAYS else []
    return out


def build_ods(spark: SparkSession, lake_root: str, touched: dict[str, list] | None = None,
              delivery: str | None = None, processing_date: str | None = None) -> dict[str, object]:
    """B20 + B53: the operational layer from the raw tables, each table with
    ``processing_date``, plus campaign budget metrics (B21) on the campaign
    dictionary.

    Of the facts only the ``touched`` days (default: all) are rebuilt, each
    from the rows that all deliveries hold of it; a day without rows goes.
    Dictionaries are those of ``delivery`` (default: the last one by name, also
    when an earlier one is loaded again); budget metrics follow the impressions.
    Row counts per entity and stage (B14) are observed during the writes and
    returned under ``"report"`` ({entity: {stage: rows}}; impressions also as
    ``"banner_report"``)."""
    touched = dict(_all_days(spark, lake_root) if touched is None else touched)
    if "banner_events" in touched:
        touched.setdefault("cd_campaign", [])
    raw = {}
    for entity, days in touched.items():
        t = lifecycle.read_table(spark, _layer(lake_root, "raw", entity))
        if t is None:
            for d in days:
                delete_path(spark, f"{_layer(lake_root, 'ods', entity)}/{lifecycle.partition_folder(DAYS[entity][0], d)}")
        elif entity in DAYS:
            raw[entity] = t.where(lifecycle.in_partitions(DAYS[entity][0], days)).drop(DELIVERY)
        else:
            last = delivery or t.agg(F.max(F.col(DELIVERY).cast("string"))).first()[0]
            raw[entity] = t.where(F.col(DELIVERY).cast("string") == last).drop(DELIVERY)
    ods = clean.ods_build(raw)
    report = ods.pop("_report", {})

    def write(entity: str, df: DataFrame) -> str:
        df, out = clean.stamp_processing_date(df, processing_date), _layer(lake_root, "ods", entity)
        if entity not in DAYS:
            return lifecycle.write_layer(df, out)
        return lifecycle.replace_partitions(df, out, DAYS[entity][0], touched[entity])

    out: dict[str, object] = dict(_concurrently(
        {entity: (lambda e=entity, d=df: write(e, d)) for entity, df in ods.items() if entity != "cd_campaign"}))
    if "cd_campaign" in ods:
        banners = lifecycle.read_table(spark, _layer(lake_root, "ods", "banner_events"))
        if banners is not None:
            out["cd_campaign"] = write("cd_campaign", marts.campaign_budget_metrics(banners, ods["cd_campaign"]))
    # Only frames that were written have filled observations (reading an
    # unfilled one would wait for an action that never comes).
    counts = {entity: {stage: int(o.get["rows"]) for stage, o in stages.items()}
              for entity, stages in report.items() if entity in out}
    out["report"] = counts
    if "banner_events" in counts:
        out["banner_report"] = counts["banner_events"]
    return out


def build_mart(spark: SparkSession, lake_root: str, processing_date: str | None = None,
               touched: dict[str, list] | None = None) -> DataFrame:
    """B26 from the operational layer; dm.campaign_daily partitioned by date.
    Rows of a date depend on the facts of that date only, so with ``touched``
    just these days of all facts are read and rewritten."""
    facts = {e: lifecycle.read_table(spark, _layer(lake_root, "ods", e)) for e in DAYS}
    days: list = []
    if touched is not None:
        days = sorted({d for e in DAYS for d in touched.get(e, []) if d is not None})
        facts = {e: t if t is None else t.where(lifecycle.in_partitions(DAYS[e][0], days)) for e, t in facts.items()}
    mart = marts.campaign_daily_full(facts["banner_events"], facts["installs"], facts["fct_actions"], processing_date)
    path = lifecycle.replace_partitions(mart, _layer(lake_root, "dm", "campaign_daily"), "date", days)
    return spark.read.parquet(path).select(*schemas.MART_COLUMNS)


def csv_flow(spark: SparkSession, delivery_root: str, lake_root: str,
             processing_date: str | None = None, delivery: str | None = None) -> DataFrame:
    """P2: delimited delivery -> raw -> ods -> dm.campaign_daily.

    A delivery may hold new days, late rows of known days, or be repeated, also
    corrected: the days it touches or touched before are rebuilt from all
    deliveries, the others stay."""
    name = delivery or _delivery_name(delivery_root)
    touched = load_raw_delivery(spark, delivery_root, lake_root, name)
    build_ods(spark, lake_root, touched, None, processing_date)
    mart = build_mart(spark, lake_root, processing_date, touched)
    delete_path(spark, _pending(lake_root, name))
    return mart


def banner_events_flow(spark: SparkSession, source: str, lake_root: str, fmt: str = "text",
                       options: dict[str, str] | None = None,
                       processing_date: str | None = None, delivery: str | None = None) -> DataFrame | None:
    """P1: messages -> raw.banner_events -> ods.banner_events -> lite mart
    (its own table: its ctr is a fraction).  Returns None when there are no
    messages (nothing is written).

    What a run reads is a delivery of its own in the raw table (default name:
    the source's last path part for files, a new one for a topic).  The days
    it touches are rebuilt from all deliveries, so neither late messages nor
    messages that the topic no longer holds shrink a stored day."""
    decoded = messages.decode_events(messages.read_messages(spark, source, fmt, options))
    if messages.skip_if_empty(decoded):
        return None
    name = delivery or (_delivery_name(source) if fmt != "kafka" else f"{source}-{uuid.uuid4().hex[:12]}")
    raw_path = _layer(lake_root, "raw", "banner_events")
    before = _touch(spark, raw_path, name, "event_date", _pending(lake_root, name, "messages"))
    lifecycle.write_layer(decoded.withColumn(DELIVERY, F.lit(name)), raw_path, [DELIVERY, "event_date"])
    days = _days_of(spark, raw_path, name, "event_date", before)
    hit = lifecycle.in_partitions("event_date", days)
    ods = clean.clean_banner_events(spark.read.parquet(raw_path).where(hit).drop(DELIVERY))
    ods_path = lifecycle.replace_partitions(ods, _layer(lake_root, "ods", "banner_events"), "event_date", days)
    lite = marts.campaign_daily_lite(spark.read.parquet(ods_path).where(hit), processing_date)
    path = lifecycle.replace_partitions(lite, _layer(lake_root, "dm", "campaign_daily_lite"), "date", days)
    delete_path(spark, _pending(lake_root, name))
    return spark.read.parquet(path).select(*schemas.MART_COLUMNS)


def ml_daily_flow(spark: SparkSession, lake_root: str, snapshot_date: str, days: int = 7) -> DataFrame:
    """P3: ml.user_features for one snapshot date (only that partition is
    replaced)."""
    banners = spark.read.parquet(_layer(lake_root, "ods", "banner_events"))
    actions = lifecycle.read_table(spark, _layer(lake_root, "ods", "fct_actions"))
    users = lifecycle.read_table(spark, _layer(lake_root, "ods", "cd_user"))
    feats = features.user_features_7d(banners, actions, users, snapshot_date, days)
    path = lifecycle.write_layer(feats, _layer(lake_root, "ml", "user_features"), "snapshot_date")
    return spark.read.parquet(path).filter(F.col("snapshot_date") == F.lit(snapshot_date).cast("date")) \
        .select(*schemas.FEATURE_COLUMNS)
