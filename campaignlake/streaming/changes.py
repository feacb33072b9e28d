"""Change data: unwrap change envelopes, route topics, append a change stream
to a table.  Works on any frame with message columns (``key``, ``value``,
``topic``), batch or streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.functions import columns as C
from campaignlake.session import new_scratch, path_exists
from campaignlake.streaming.sink import append_batch, append_stream, run_batches

# Routing of the change topic and the sink commit interval.
ROUTE_REGEX = "cdc.ods.fct_actions"
ROUTE_REPLACEMENT = "raw_actions"
COMMIT_INTERVAL = "300 seconds"

MESSAGE_DDL = "key string, value string, topic string, ts_ms bigint, seq int"


def parse_feed_lines(lines: DataFrame) -> DataFrame:
    """Newline-delimited JSON message records -> key, value, topic, ts_ms, seq."""
    return lines.select(F.from_json("value", MESSAGE_DDL).alias("m")).select("m.*")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Bounded read of a folder of message records."""
    return parse_feed_lines(spark.read.text(path))


# B45 -----------------------------------------------------------------------
_IMAGE_COLUMNS = ("user_id", "session_start", "actions")
_SERVICE_FIELDS = ("__deleted", "__op", "__ts_ms", "__source_ts_ms")  # added by a source that unwraps itself


def _parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with ``_top``: the JSON object's fields as a string map
    (NULL when the value is not a JSON object) and ``_form``: 'tombstone',
    'envelope' (a field ``op`` and an image), 'row' (the image itself) or
    'other'."""
    top = F.from_json(F.col("value").cast("string"), "map<string,string>")
    df = messages.withColumn("_top", top)
    t = F.col("_top")
    envelope = F.map_contains_key(t, "op") & (F.map_contains_key(t, "after") | F.map_contains_key(t, "before"))
    image = F.exists(F.map_keys(t), lambda k: k.isin(*_IMAGE_COLUMNS))
    return df.withColumn("_form", F.when(F.col("value").isNull(), "tombstone").when(t.isNull(), "other")
                         .when(envelope, "envelope").when(image, "row").otherwise("other"))


def change_time(text: Column) -> Column:
    """Time of a change record: text, or the source's epoch encodings, told
    apart by size (seconds below 10^11, milliseconds below 10^14, else
    microseconds)."""
    n = text.try_cast("bigint")
    micros = F.when(F.abs(n) < 10 ** 11, n * 1_000_000).when(F.abs(n) < 10 ** 14, n * 1000).otherwise(n)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    parts = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.floor(micros / 1_000_000)).cast("decimal(18,6)")
                               + (F.pmod(micros, F.lit(1_000_000)) / 1_000_000).cast("decimal(18,6)"))
    return F.when(n.isNotNull(), start + parts).otherwise(C.parse_event_time(text))


def unwrap_changes(messages: DataFrame) -> DataFrame:
    """Change record -> new row image.  Of envelopes, creates, updates and
    snapshot reads keep their ``after`` image and deletes are dropped; a row
    that the source has unwrapped already passes through (unless it marks a
    delete); a tombstone (NULL value) becomes a row with only its key and
    ``is_tombstone``.  Anything else goes to ``quarantined_changes``.

    The image is parsed once as a string map, so fields that the declared
    columns do not know (a column added at the source) are not lost: they
    are kept as JSON text in ``extra_fields`` (NULL when there are none)."""
    df = _parsed(messages)
    top, form = F.col("_top"), F.col("_form")
    inner = F.from_json(F.element_at(top, "after"), "map<string,string>")
    df = df.withColumn("_image", F.when(form == "envelope", inner).when(form == "row", top))
    op = F.when(form == "envelope", F.element_at(top, "op")).when(form == "row", F.element_at(top, "__op"))
    ms = F.when(form == "envelope", F.element_at(top, "ts_ms")).when(
        form == "row", F.coalesce(F.element_at(top, "__ts_ms"), F.element_at(top, "__source_ts_ms")))
    deleted = F.coalesce(F.lower(F.element_at(top, "__deleted")) == "true", F.lit(False))
    df = df.withColumn("_op", op).withColumn("_ms", ms.try_cast("bigint"))
    kept = df.where((form == "tombstone") | (form == "envelope") & F.col("_op").isin("c", "u", "r")
                    | (form == "row") & ~deleted & F.coalesce(F.col("_op") != "d", F.lit(True)))
    image = F.col("_image")
    known = F.array(*[F.lit(c) for c in (*_IMAGE_COLUMNS, *_SERVICE_FIELDS)])
    extra = F.map_filter(image, lambda k, v: ~F.array_contains(known, k))
    return kept.select(
        "key",
        F.element_at(image, "user_id").try_cast("bigint").alias("user_id"),
        change_time(F.element_at(image, "session_start")).alias("session_start"),
        F.element_at(image, "actions").alias("actions"),
        F.col("_op").alias("op"),
        F.col("_ms").alias("ts_ms"),
        F.when(F.size(extra) > 0, F.to_json(extra)).alias("extra_fields"),
        (form == "tombstone").alias("is_tombstone"),
    )


def quarantined_changes(messages: DataFrame) -> DataFrame:
    """Messages that are no change record (not JSON, or neither envelope nor
    row), with their text as ``raw_value``."""
    return _parsed(messages).where("_form = 'other'").select("key", F.col("value").cast("string").alias("raw_value"))


# B46 -----------------------------------------------------------------------
def route_topics(messages: DataFrame, regex: str = ROUTE_REGEX, replacement: str = ROUTE_REPLACEMENT,
                 topic_col: str = "topic") -> DataFrame:
    """Rename logical topics by a regular expression (whole-name match)."""
    return messages.withColumn(topic_col, F.regexp_replace(F.col(topic_col), f"^(?:{regex})$", replacement))


def route_stream_to_tables(spark: SparkSession, source: str, root: str, checkpoint: str | None = None,
                           regex: str = ROUTE_REGEX, replacement: str = ROUTE_REPLACEMENT,
                           available_now: bool = True):
    """Message records (folder) -> routed topic names -> one Parquet folder
    per target topic under ``root`` (``topic=<name>``), appended by a stream."""
    msgs = route_topics(parse_feed_lines(spark.readStream.format("text").load(source)), regex, replacement)
    return append_stream(msgs, root, checkpoint or new_scratch(spark, "checkpoint-routes"), available_now, "topic",
                         COMMIT_INTERVAL)


def latest_rows(table: DataFrame, key=("key",), order: str = "ts_ms") -> DataFrame:
    """Newest row per key (the append sink keeps every version)."""
    key = list(key)
    rest = [c for c in table.columns if c not in key and c != order]
    last = F.max(F.struct(order, *rest)).alias("_last")
    return (table.groupBy(*key).agg(last)
            .select(*key, *[F.col("_last").getField(c).alias(c) for c in [order] + rest])
            .select(*table.columns))


# B47 -----------------------------------------------------------------------
def append_stream_to_table(spark: SparkSession, source: str, table_path: str,
                           checkpoint: str | None = None, available_now: bool = True,
                           interval: str = COMMIT_INTERVAL, max_files_per_trigger: int | None = None,
                           fmt: str = "text", options: dict[str, str] | None = None,
                           create_if_missing: bool = True, quarantine_path: str | None = None):
    """Change messages (folder of JSON records, or a Kafka topic) -> unwrapped rows appended to a
    Parquet table.  Tombstones are not written; updates append a second row
    (no key columns are configured), use ``latest_rows`` on read for the
    newest version.  New columns are admitted (read with mergeSchema).
    With ``create_if_missing=False`` the target table must already exist
    (a sink that does not create tables).  With ``quarantine_path``
    messages that are no change record are appended there.  Returns the
    started query (already finished for ``available_now``)."""
    if not create_if_missing and not path_exists(spark, table_path):
        raise FileNotFoundError(f"target table {table_path} does not exist")
    if fmt == "kafka":  # source = topic; options carry the brokers
        reader = spark.readStream.format("kafka").option("subscribe", source) \
            .option("startingOffsets", "earliest")
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        msgs = reader.load().select(F.col("key").cast("string").alias("key"),
                                    F.col("value").cast("string").alias("value"), "topic")
    else:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        msgs = parse_feed_lines(reader.load(source))
    ckpt = checkpoint or new_scratch(spark, "checkpoint-changes")

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = unwrap_changes(batch).filter(~F.col("is_tombstone")).drop("is_tombstone")
        append_batch(rows, table_path, ckpt, batch_id)
        if quarantine_path:
            append_batch(quarantined_changes(batch), quarantine_path, ckpt, batch_id)

    return run_batches(msgs, process, ckpt, available_now, interval)


def read_appended(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(table_path)
