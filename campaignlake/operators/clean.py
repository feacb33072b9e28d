"""Cleaning and conformance of raw entities into the operational layer.

De-duplication keeps one row per key chosen by an explicit order, so the
survivor is deterministic.  It is computed as a grouped ``min`` over a
struct of (order columns, remaining columns): the aggregate is combined
map-side before the shuffle, so a key that holds a large share of all rows
is reduced inside each input task instead of being sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window

from campaignlake import schemas
from campaignlake.functions import columns as C


# B11 -----------------------------------------------------------------------
def drop_null_key(df: DataFrame, key: Sequence[str] | str = "user_id") -> DataFrame:
    """Remove rows whose key column(s) are NULL."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.dropna(subset=keys)


# B12 / B13 -----------------------------------------------------------------
def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per ``key``: the smallest by ``order`` then all other columns
    (NULLs first), i.e. ``row_number() over (partition by key order by ...) = 1``."""
    key, order = list(key), list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = order + rest
    if not packed:
        return df.select(*key).distinct()
    first = F.min(F.struct(*[F.col(c) for c in packed])).alias("_first")
    out = df.groupBy(*key).agg(first)
    return out.select(*key, *[F.col("_first").getField(c).alias(c) for c in packed]).select(*df.columns)


def dedup_events(df: DataFrame, key: Sequence[str] = schemas.BANNER_EVENTS.key,
                 tiebreak: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per (banner_id, user_id, event_ts); survivor = smallest event_id,
    then the remaining columns."""
    return keep_first(df, key, [c for c in tiebreak if c in df.columns])


def dedup_dimension(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per primary key; survivor = smallest remaining columns in order."""
    return keep_first(df, key)


def clean_banner_events(raw: DataFrame) -> DataFrame:
    """B11 + B12: drop rows without a user, then exact de-duplication."""
    return dedup_events(drop_null_key(raw, "user_id"))


# B14 -----------------------------------------------------------------------
def dedup_report(raw: DataFrame, key: Sequence[str] = schemas.BANNER_EVENTS.key,
                 null_key: str = "user_id") -> DataFrame:
    """One row: rows read, rows with a user, rows after de-duplication.

    One shuffle: rows are first counted per de-dup key (combined map-side),
    then the three totals come from those counts.
    """
    per_key = raw.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    has_key = F.col(null_key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_read"),
        F.coalesce(F.sum(F.when(has_key, F.col("_n"))), F.lit(0)).cast("bigint").alias("rows_with_user"),
        F.count_if(has_key).cast("bigint").alias("rows_deduplicated"),
    )


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in during the next action on ``df``
    (no extra job); read it with ``observation.get['rows']`` afterwards."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# B15 -----------------------------------------------------------------------
def dedup_within_window(df: DataFrame, key: Sequence[str] = ("banner_id", "user_id"),
                        ts: str = "event_ts", order: str = "event_id",
                        minutes: int = 10, prior: DataFrame | None = None) -> DataFrame:
    """Keep a row unless the previous row of the same key (by ts, then id) is
    less than ``minutes`` earlier.

    Copies at the same time collapse first (grouped, combined map-side).  The
    window is then partitioned by key *and* a time bucket as wide as the
    rule, so one very active key is spread over many tasks.  The last event
    of each bucket (a grouped maximum: key and time only) is context for the
    next one, so the previous row of a bucket's first row is found by the same
    ``lag``.  ``prior`` (key columns, ``ts`` and ``order``) holds earlier
    events that are context only (incremental use on micro-batches); at equal
    times they come first.  NULL keys are keys like others.
    """
    key = list(key)
    width_us = minutes * 60 * 1_000_000
    ts_type = df.schema[ts].dataType.simpleString()

    def bucketed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.floor(C.epoch_micros(ts, ts_type) / F.lit(width_us)))

    # Rows with the same key and time: only the smallest id can survive (the
    # others follow it at distance 0), so collapse them first with the
    # map-side-combined aggregate; a burst of copies never reaches the window.
    firsts = bucketed(keep_first(df, [*key, ts], [order]))
    slim = firsts.select(*key, ts, order, "_bucket")
    parts = [firsts.withColumn("_own", F.lit(True))]
    if prior is not None:
        context = bucketed(prior.select(*key, ts, order))
        parts.append(context.withColumn("_own", F.lit(False)))
        slim = slim.unionByName(context)
    last = slim.groupBy(*key, "_bucket").agg(F.max(F.struct(ts, order)).alias("_last"))
    parts.append(last.select(*key, F.col(f"_last.{ts}").alias(ts), F.col(f"_last.{order}").alias(order),
                             (F.col("_bucket") + 1).alias("_bucket"), F.lit(False).alias("_own")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    w = Window.partitionBy(*key, "_bucket").orderBy(F.col(ts), F.col("_own"), F.col(order))
    with_prev = rows.withColumn("_prev", F.lag(ts).over(w)).filter("_own")
    limit = F.col(ts) - F.expr(f"INTERVAL {minutes} MINUTES")
    return with_prev.filter(F.col("_prev").isNull() | (F.col("_prev") <= limit)).select(*df.columns)


def clean_banner_events_observed(raw: DataFrame) -> tuple[DataFrame, dict[str, Observation]]:
    """B11 + B12 with the B14 counts observed on the way: the counts of rows
    read, rows with a user and rows after de-duplication fill in during the
    one action that consumes the result (no extra count jobs)."""
    read, o_read = observe_rows(raw, "rows_read")
    with_user, o_user = observe_rows(drop_null_key(read, "user_id"), "rows_with_user")
    out, o_out = observe_rows(dedup_events(with_user), "rows_deduplicated")
    return out, {"rows_read": o_read, "rows_with_user": o_user, "rows_deduplicated": o_out}


# B05 -----------------------------------------------------------------------
def normalize_null_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Blank text or the word NULL (any case) -> NULL, on all string columns
    (or the given ones)."""
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(*[C.null_if_blank_text(c).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


# B16 -----------------------------------------------------------------------
def parse_campaigns(raw: DataFrame) -> DataFrame:
    """Campaign dictionary: budget with decimal comma -> double, dd.MM.yyyy
    text -> date, one row per campaign_id."""
    parsed = raw.select(
        F.col("campaign_id").try_cast("bigint").alias("campaign_id"),
        C.parse_decimal_comma("daily_budget").alias("daily_budget"),
        C.parse_dotted_date("start_date").alias("start_date"),
        C.parse_dotted_date("end_date").alias("end_date"),
    )
    return dedup_dimension(drop_null_key(parsed, "campaign_id"), ["campaign_id"])


# B17 -----------------------------------------------------------------------
def parse_users(raw: DataFrame) -> DataFrame:
    """User dictionary: blank-safe dates, no NULL ids, one row per user_id."""
    parsed = raw.select(
        F.col("user_id").try_cast("bigint").alias("user_id"),
        C.null_if_blank_text("segment").alias("segment"),
        C.null_if_blank_text("tariff").alias("tariff"),
        C.blank_safe_date("date_create").alias("date_create"),
        C.blank_safe_date("date_end").alias("date_end"),
    )
    return dedup_dimension(drop_null_key(parsed, "user_id"), ["user_id"])


def parse_banners(raw: DataFrame) -> DataFrame:
    """Banner dictionary: typed id, one row per banner_id."""
    typed = raw.withColumn("banner_id", F.col("banner_id").try_cast("bigint"))
    return dedup_dimension(drop_null_key(typed, "banner_id"), ["banner_id"])


# B18 -----------------------------------------------------------------------
def add_event_identity(df: DataFrame) -> DataFrame:
    """Fill a missing or NULL event_id with the deterministic content hash."""
    ident = C.event_identity("banner_id", "user_id", "event_ts")
    if "event_id" not in df.columns:
        return df.withColumn("event_id", ident)
    return df.withColumn("event_id", F.coalesce(F.col("event_id"), ident))


# B19 -----------------------------------------------------------------------
def check_relations(banners: DataFrame, installs: DataFrame, actions: DataFrame,
                    cd_banner: DataFrame, cd_campaign: DataFrame, cd_user: DataFrame) -> DataFrame:
    """Primary-key uniqueness of the dictionaries and fact keys missing from
    their dictionary: rows (check, relation, violations).

    duplicate_key: rows of a dictionary beyond the first of their key (rows
    without a key are not counted).  orphan: fact rows whose key, not NULL, is
    in no dictionary row.  The dictionaries are given as delivered.

    One pass: every fact and every dictionary is counted by key (combined
    map-side); the counts of a relation's two sides meet in one grouped sum."""
    # one pre-aggregation of the impressions serves their three relations
    shown = banners.groupBy("banner_id", "campaign_id", "user_id").agg(F.count(F.lit(1)).alias("_rows"))
    facts = [(shown, "banner_events", "banner_id", "cd_banner"), (shown, "banner_events", "campaign_id", "cd_campaign"),
             (shown, "banner_events", "user_id", "cd_user"),
             (installs.withColumn("_rows", F.lit(1)), "installs", "user_id", "cd_user"),
             (actions.withColumn("_rows", F.lit(1)), "fct_actions", "user_id", "cd_user")]
    dictionaries = {"cd_banner": (cd_banner, "banner_id"), "cd_campaign": (cd_campaign, "campaign_id"),
                    "cd_user": (cd_user, "user_id")}
    names = [f"{fact}.{k}->{d}" for _, fact, k, d in facts]

    def by_key(df: DataFrame, key: str, rows: Column, is_fact: bool, relations: list[str]) -> DataFrame:
        counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("_k")).agg(F.sum(rows).alias("_n"))
        return counts.select("_k", F.explode(F.array(*map(F.lit, relations))).alias("relation"),
                             F.when(F.lit(is_fact), F.col("_n")).otherwise(0).alias("_fact"),
                             F.when(F.lit(not is_fact), F.col("_n")).otherwise(0).alias("_dict"))

    parts = [by_key(df, k, F.col("_rows"), True, [name]) for (df, _, k, _), name in zip(facts, names)]
    parts += [by_key(df, k, F.lit(1), False, [d, *(n for n in names if n.endswith(f"->{d}"))])
              for d, (df, k) in dictionaries.items()]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    per_key = both.groupBy("relation", "_k").agg(F.sum("_fact").alias("_fact"), F.sum("_dict").alias("_dict"))
    is_orphan = F.col("relation").contains("->")
    bad = F.when(is_orphan, F.when(F.col("_dict") == 0, F.col("_fact"))).otherwise(F.col("_dict") - 1)
    found = per_key.groupBy("relation").agg(F.sum(bad).alias("_bad"))
    # relations whose tables are empty have no row above
    spark = banners.sparkSession
    every = spark.range(1).select(F.explode(F.array(*map(F.lit, [*dictionaries, *names]))).alias("relation"))
    return every.join(found, "relation", "left").select(
        F.when(is_orphan, "orphan").otherwise("duplicate_key").alias("check"), "relation",
        F.coalesce("_bad", F.lit(0)).cast("bigint").alias("violations"))


# B53 -----------------------------------------------------------------------
def stamp_processing_date(df: DataFrame, processing_date: str | None = None) -> DataFrame:
    """Service column with the load date (a fixed date, or today)."""
    value = F.lit(processing_date).cast("date") if processing_date else F.current_date()
    return df.withColumn("processing_date", value)


# B20 -----------------------------------------------------------------------
def ods_build(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All operational entities from the raw ones (keys as in ``schemas.ENTITIES``).

    Facts lose rows without a user; impressions are de-duplicated; the
    dictionaries are parsed and keyed.  Campaign budget metrics are added
    by ``marts.campaign_budget_metrics`` from the de-duplicated impressions.
    Row counts per stage (read, with key, after de-duplication) are observed
    during the write that consumes each frame; they are returned under
    ``"_report"`` as {entity: {stage: Observation}}.
    """
    out: dict[str, DataFrame] = {}
    report: dict[str, dict[str, Observation]] = {}

    def counted(entity: str, df: DataFrame, stage: str) -> DataFrame:
        df, obs = observe_rows(df, f"{entity}_{stage}")
        report.setdefault(entity, {})[stage] = obs
        return df

    if "banner_events" in raw:
        out["banner_events"], report["banner_events"] = clean_banner_events_observed(raw["banner_events"])
    for entity in ("installs", "fct_actions"):
        if entity in raw:
            read = counted(entity, raw[entity], "rows_read")
            out[entity] = counted(entity, drop_null_key(read, "user_id"), "rows_with_user")
    for entity, parse in (("cd_banner", parse_banners), ("cd_campaign", parse_campaigns),
                          ("cd_user", parse_users)):
        if entity in raw:
            out[entity] = counted(entity, parse(counted(entity, raw[entity], "rows_read")), "rows_deduplicated")
    out["_report"] = report  # type: ignore[assignment]
    return out
