"""Text deliveries derived from the driver tables: delimited files, JSON
messages and change-feed messages.

The ingest jobs must read what the sources really deliver (text with
Russian bracketed headers, JSON with malformed messages, change envelopes).
These builders render the domain projection into those forms with Spark and
write them, partition by partition, into a folder; the ingest queries then
read them back.  Every rule is deterministic; ``n`` below is the numeric
event id.

Malformed lines (banner file): n % 37 = 0 -> two fields short;
otherwise n % 43 = 0 -> one field too many; otherwise n % 41 = 0 -> click
flag 'yes'.
Malformed messages: n % 89 = 0 -> not JSON; n % 83 = 0 -> campaign_id is
the string "x"; n % 79 = 0 -> unparsable event_ts.
Change feed of actions: every action is created (op c); n % 13 = 0 -> the
created image carries a column the table does not have yet ("channel");
n % 7 = 0 -> then updated to 'registration' (op u); n % 11 = 0 -> then
deleted (op d) and followed by a tombstone (NULL value).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.functions.columns import epoch_micros
from campaignlake.sources import domain as D

# ---------------------------------------------------------------------------
# Headers as delivered (bracketed explanations included).
BANNER_HEADER = ("banner_id", "campaign_id", "user_id", "timestamp",
                 "placement (сайт/приложение/соцсеть)", "device_type", "os", "geo",
                 "is_clicked (0/1)")
INSTALLS_HEADER = ("user_id", "install_timestamp", "source (баннер / органика / другое)")
ACTIONS_HEADER = ("user_id", "session_start", "actions (регистрация, первый заказ и т.д.)")
CD_BANNER_HEADER = ("banner_id", "creative_type (статика/видео/анимация)",
                    "message (сообщение на баннере)", "size", "target_audience_segment")
CD_CAMPAIGN_HEADER = ("campaign_id", "daily_budget", "start_date", "end_date")
CD_USER_HEADER = ("User_id", "segment", "tariff", "date_create", "date_end")
CHANGE_TOPIC = "cdc.ods.fct_actions"
# ---------------------------------------------------------------------------

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MESSAGE_TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss"


def _txt(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(""))


def _ts_txt(c: str) -> Column:
    return F.coalesce(F.date_format(c, TS_TEXT), F.lit(""))


def event_number(col: str = "event_id") -> Column:
    """Numeric part of a projected event id ('123', '123-dup' -> 123)."""
    return F.substring_index(F.col(col), "-", 1).cast("bigint")


def write_lines(lines: DataFrame, header: tuple[str, ...], path: str, sep: str = ";") -> str:
    """Write a ``value`` column of pre-joined lines as delimited files, each
    file starting with the header line.  The writer's own separator and
    quoting are switched off so that lines are written verbatim."""
    (lines.select(F.col("value").alias(sep.join(header)))
     .write.mode("overwrite").option("header", True).option("sep", "\u0001")
     .option("quote", "\u0000").option("escapeQuotes", False).csv(path))
    return path


def grow_files(lines: DataFrame, header: tuple[str, ...], folder: str, files: int = 4, cut: int = 0, sep: str = ";") -> None:
    """Append a ``value`` column of lines to the files log-<n>.csv of ``folder``
    as a program does that is still writing: the last ``cut`` bytes of what a
    file got are held back (in a hidden file) until it grows again.  New files
    start with the header."""
    from pyarrow import fs

    first = (sep.join(header) + "\n").encode()

    def append(batches):
        store, root = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(root)
        for batch in batches:
            for n, part in batch.groupby("file"):
                path, tail = f"{root}/log-{n}.csv", f"{root}/.tail-{n}"
                old = b"" if store.get_file_info(path).type != fs.FileType.NotFound else first
                if store.get_file_info(tail).type != fs.FileType.NotFound:
                    with store.open_input_file(tail) as f:
                        old = f.read()
                data = old + "".join(f"{v}\n" for v in part["value"]).encode()
                with store.open_append_stream(path) as f:
                    f.write(data[:len(data) - cut])
                with store.open_output_stream(tail) as f:
                    f.write(data[len(data) - cut:])
                yield part[["file"]].head(1)

    placed = lines.select("value", F.pmod(F.xxhash64("value"), F.lit(files)).cast("int").alias("file"))
    placed.repartition(files, "file").sortWithinPartitions("file").mapInPandas(append, "file int").count()


# --- delimited files ----------------------------------------------------------

def banner_lines(raw_banners: DataFrame, malformed: bool = False) -> DataFrame:
    fields = [_txt("banner_id"), _txt("campaign_id"), _txt("user_id"), _ts_txt("event_ts"),
              _txt("placement"), _txt("device_type"), _txt("os"), _txt("geo")]
    flag = _txt("is_clicked")
    if not malformed:
        return raw_banners.select(F.concat_ws(";", *fields, flag).alias("value"))
    n = event_number()
    full = F.concat_ws(";", *fields, flag)
    value = (F.when(n % 37 == 0, F.concat_ws(";", *fields[:7]))
             .when(n % 43 == 0, F.concat_ws(";", *fields, flag, F.lit("extra")))
             .when(n % 41 == 0, F.concat_ws(";", *fields, F.lit("yes")))
             .otherwise(full))
    return raw_banners.select(value.alias("value"))


def installs_lines(raw_installs: DataFrame) -> DataFrame:
    return raw_installs.select(F.concat_ws(";", _txt("user_id"), _ts_txt("install_timestamp"),
                                           _txt("source")).alias("value"))


def actions_lines(raw_actions: DataFrame) -> DataFrame:
    return raw_actions.select(F.concat_ws(";", _txt("user_id"), _ts_txt("session_start"),
                                          _txt("actions")).alias("value"))


def dictionary_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws(";", *[_txt(c) for c in df.columns]).alias("value"))


FIRST_DELIVERY_BEFORE = "2024-01-16"
LATE_USERS = 29


def delivered_in(facts: DataFrame, ts: str, part: int | None) -> DataFrame:
    """Rows of the first (1) or second (2) of two deliveries, or all (None).
    The first holds the days before ``FIRST_DELIVERY_BEFORE``, but rows of
    every 29th user and every 29th second come late, with the second."""
    if part is None:
        return facts
    early = F.col(ts) < F.lit(FIRST_DELIVERY_BEFORE).cast("timestamp_ntz")
    late = (F.coalesce(F.col("user_id"), F.lit(1)) % LATE_USERS == 0) | (F.second(ts) % LATE_USERS == 0)
    first = F.coalesce(early & ~late, F.lit(False))
    return facts.where(first if part == 1 else ~first)


def write_delimited_delivery(spark: SparkSession, sf_dir: str, root: str, part: int | None = None,
                             malformed: bool = False) -> dict[str, str]:
    """All six delimited files of one delivery under ``root``; returns paths.
    ``part``: see ``delivered_in``; ``malformed``: banner lines with wrong
    field counts and flags."""
    jobs = {
        "banner_events": lambda: write_lines(
            banner_lines(delivered_in(D.raw_banner_events(spark, sf_dir), "event_ts", part), malformed),
            BANNER_HEADER, f"{root}/Fct_banners_show"),
        "installs": lambda: write_lines(
            installs_lines(delivered_in(D.raw_installs(spark, sf_dir), "install_timestamp", part)),
            INSTALLS_HEADER, f"{root}/Installs"),
        "fct_actions": lambda: write_lines(
            actions_lines(delivered_in(D.raw_actions(spark, sf_dir), "session_start", part)),
            ACTIONS_HEADER, f"{root}/Fct_actions"),
        "cd_banner": lambda: write_lines(dictionary_lines(D.raw_cd_banner(spark, sf_dir)),
                                         CD_BANNER_HEADER, f"{root}/CD_banner"),
        "cd_campaign": lambda: write_lines(dictionary_lines(D.raw_cd_campaign(spark, sf_dir)),
                                           CD_CAMPAIGN_HEADER, f"{root}/CD_campaign"),
        "cd_user": lambda: write_lines(dictionary_lines(D.raw_cd_user(spark, sf_dir)),
                                       CD_USER_HEADER, f"{root}/CD_user"),
    }
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        paths = {k: f.result() for k, f in futures.items()}
    return paths


# --- JSON messages ------------------------------------------------------------

def banner_messages(raw_banners: DataFrame, malformed: bool = True) -> DataFrame:
    """One JSON message per impression (event_ts as yyyy-MM-ddTHH:mm:ss text)."""
    base = ["event_id", "banner_id", "campaign_id", "user_id"]
    tail = ["placement", "device_type", "os", "geo", "is_clicked"]
    ts = F.date_format("event_ts", MESSAGE_TS_TEXT).alias("event_ts")
    good = F.to_json(F.struct(*base, ts, *tail))
    if not malformed:
        return raw_banners.select(good.alias("value"))
    n = event_number()
    wrong_type = F.to_json(F.struct("event_id", "banner_id", F.lit("x").alias("campaign_id"),
                                    "user_id", ts, *tail))
    bad_ts = F.to_json(F.struct(*base, F.lit("2024-13-45T99:00:00").alias("event_ts"), *tail))
    value = (F.when(n % 89 == 0, F.concat(F.lit("not json: "), F.col("event_id")))
             .when(n % 83 == 0, wrong_type)
             .when(n % 79 == 0, bad_ts)
             .otherwise(good))
    return raw_banners.select(value.alias("value"))


def write_messages(messages: DataFrame, path: str) -> str:
    messages.select("value").write.mode("overwrite").text(path)
    return path


# --- change feed --------------------------------------------------------------

def _epoch_ms(ts: str) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(1000)).cast("bigint")


def action_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-feed messages of ods.fct_actions: key, value (JSON envelope or
    NULL for a tombstone), topic, ts_ms, seq (order within the key)."""
    ev = (D.read_table(spark, sf_dir, "events")
          .filter(F.col("event_type").isin("purchase", "error"))
          .select("event_id", "user_id", "ts",
                  D.pick(F.col("event_id") % 5, D.ACTION_NAMES).alias("actions")))
    n = F.col("event_id")
    image = F.struct("user_id", F.date_format("ts", TS_TEXT).alias("session_start"), "actions")
    updated = F.struct("user_id", F.date_format("ts", TS_TEXT).alias("session_start"),
                       F.lit("registration").alias("actions"))
    none = F.lit(None).cast("struct<user_id:bigint,session_start:string,actions:string>")
    key = F.to_json(F.struct(n.alias("id")))
    ms = _epoch_ms("ts")

    def env(before, after, op, offset_ms):
        return F.to_json(F.struct(before.alias("before"), after.alias("after"),
                                  F.lit(op).alias("op"), (ms + offset_ms).alias("ts_ms")))

    wider = F.struct("user_id", F.date_format("ts", TS_TEXT).alias("session_start"), "actions",
                     F.lit("app").alias("channel"))
    created = F.when(n % 13 == 0, env(none, wider, "c", 0)).otherwise(env(none, image, "c", 0))
    create = ev.select(key.alias("key"), created.alias("value"),
                       (ms + 0).alias("ts_ms"), F.lit(0).alias("seq"))
    update = ev.filter(n % 7 == 0).select(key.alias("key"), env(image, updated, "u", 1000).alias("value"),
                                          (ms + 1000).alias("ts_ms"), F.lit(1).alias("seq"))
    delete = ev.filter(n % 11 == 0).select(
        key.alias("key"),
        env(F.when(n % 7 == 0, updated).otherwise(image), none, "d", 2000).alias("value"),
        (ms + 2000).alias("ts_ms"), F.lit(2).alias("seq"))
    tomb = ev.filter(n % 11 == 0).select(key.alias("key"), F.lit(None).cast("string").alias("value"),
                                         (ms + 2001).alias("ts_ms"), F.lit(3).alias("seq"))
    feed = create.unionByName(update).unionByName(delete).unionByName(tomb)
    return feed.withColumn("topic", F.lit(CHANGE_TOPIC))


def action_change_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``action_change_feed`` and the other forms that arrive: n % 17 = 0 ->
    the row already unwrapped at the source, its time as epoch microseconds
    (n even) or milliseconds (n odd); n % 34 = 17 of them mark a delete;
    n % 19 = 0 -> a value that is not JSON; n % 23 = 0 -> JSON that is no
    change record."""
    ev = (D.read_table(spark, sf_dir, "events")
          .filter(F.col("event_type").isin("purchase", "error"))
          .select("event_id", "user_id", "ts", D.pick(F.col("event_id") % 5, D.ACTION_NAMES).alias("actions")))
    n = F.col("event_id")
    key, ms = F.to_json(F.struct(n.alias("id"))), _epoch_ms("ts")
    time = F.when(n % 2 == 0, epoch_micros("ts")).otherwise(ms)
    row = F.to_json(F.struct("user_id", time.alias("session_start"), "actions",
                             F.when(n % 34 == 17, "true").otherwise("false").alias("__deleted"), ms.alias("__ts_ms")))

    def rows(where: Column, value: Column, seq: int) -> DataFrame:
        return ev.where(where).select(key.alias("key"), value.alias("value"), (ms + seq).alias("ts_ms"),
                                      F.lit(seq).alias("seq"), F.lit(CHANGE_TOPIC).alias("topic"))

    return (action_change_feed(spark, sf_dir).unionByName(rows(n % 17 == 0, row, 4))
            .unionByName(rows(n % 19 == 0, F.concat(F.lit("not json "), n.cast("string")), 5))
            .unionByName(rows(n % 23 == 0, F.to_json(F.struct(n.alias("other"))), 6)))


def write_change_feed(feed: DataFrame, path: str) -> str:
    """Messages as JSON lines {key, value, topic, ts_ms, seq} (value may be null)."""
    feed.select(F.to_json(F.struct("key", "value", "topic", "ts_ms", "seq"),
                          {"ignoreNullFields": "false"}).alias("value")) \
        .write.mode("overwrite").text(path)
    return path


# SQL twins of the expected, decoded outcomes (DuckDB dialect) ---------------

def sql_event_number(col: str = "event_id") -> str:
    return f"CAST(split_part({col}, '-', 1) AS BIGINT)"
