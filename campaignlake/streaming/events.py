"""Incremental jobs on message and file streams.

* ``stream_banner_events``: decode -> drop rows without user or event time
  -> watermark -> exact de-duplication -> Parquet table (B49).
* ``stream_dedup_within_window``: the 10-minute rule of B15 with explicit
  state (the recent events), keyed by (banner_id, user_id).
* ``ship_lines``: tail delimited files into JSON log messages (B48).

The built-in watermark operators need a TIMESTAMP event time; decoded
times are TIMESTAMP_NTZ, so they are read as UTC instants and turned back
into the same wall clock for output (independent of the session zone).  Backfills must replay files in event-time order (or run
as one micro-batch): rows older than the watermark are dropped by design.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake import schemas
from campaignlake.functions import columns as C
from campaignlake.session import delete_path, new_scratch
from campaignlake.sources.growing import growing_lines
from campaignlake.sources.messages import decode_events
from campaignlake.streaming.sink import append_batch, append_stream, run_batches

# De-duplication window, log topic and log type.
WATERMARK = "10 minutes"
WINDOW_MINUTES = 10
LOG_TOPIC = "filebeat-logs"
LOG_TYPE = "csv"

_OUT_COLUMNS = [c for c, _ in schemas.BANNER_EVENTS.columns] + ["event_date"]


def message_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None,
                   fmt: str = "text", options: dict[str, str] | None = None) -> DataFrame:
    """Unbounded messages with a ``value`` column: a folder of
    newline-delimited messages (``fmt="text"``) or a Kafka topic
    (``fmt="kafka"``, ``source`` = topic, options carry the brokers; the
    Kafka connector jar must be on the classpath)."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", source).option("startingOffsets", "earliest")
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(source)


def _message_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None,
                    fmt: str = "text", options: dict[str, str] | None = None) -> DataFrame:
    decoded = decode_events(message_stream(spark, source, max_files_per_trigger, fmt, options))
    return (decoded.filter(F.col("user_id").isNotNull() & F.col("event_ts").isNotNull())
            .withColumn("event_ts", C.ntz_to_instant("event_ts")))


# B49 -----------------------------------------------------------------------
def stream_banner_events(spark: SparkSession, source: str, table_path: str,
                         checkpoint: str | None = None, watermark: str = WATERMARK,
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         fmt: str = "text", options: dict[str, str] | None = None):
    """Messages (folder or topic) -> cleaned, de-duplicated banner events
    (first arrival of each (banner_id, user_id, event_ts) survives)."""
    events = _message_stream(spark, source, max_files_per_trigger, fmt, options)
    deduped = (events.withWatermark("event_ts", watermark)
               .dropDuplicates(["banner_id", "user_id", "event_ts"])
               .withColumn("event_ts", C.instant_to_ntz("event_ts")))
    return append_stream(deduped.select(*_OUT_COLUMNS), table_path,
                         checkpoint or new_scratch(spark, "checkpoint-banners"), available_now, "event_date")


# B15 (stream) ----------------------------------------------------------------
def stream_dedup_within_window(spark: SparkSession, source: str, table_path: str,
                               checkpoint: str | None = None, minutes: int = WINDOW_MINUTES,
                               lateness_minutes: int = WINDOW_MINUTES, available_now: bool = True,
                               max_files_per_trigger: int | None = None, fmt: str = "text",
                               options: dict[str, str] | None = None):
    """Drop an event less than ``minutes`` after the previous event of the
    same (banner_id, user_id), incrementally.

    Each micro-batch is handled set-based (``clean.dedup_within_window``)
    with the recent events of earlier batches as context, so a late row is
    judged by its own neighbours.  These are kept in a versioned Parquet table
    next to the stream checkpoint (version = batch id), so a replayed batch
    reads the same state; they reach back ``minutes`` + ``lateness_minutes``
    from the latest event.  Results equal the batch rule for rows that are at
    most ``lateness_minutes`` late, but for one case: a row that was written
    before a late row came that precedes it by less than ``minutes`` stays.
    ``max_files_per_trigger`` (or maxOffsetsPerTrigger among the options)
    bounds a micro-batch."""
    from campaignlake.operators import clean, lifecycle
    from campaignlake.session import path_exists

    ckpt = checkpoint or new_scratch(spark, "checkpoint-window")
    state_path = f"{ckpt}/recent_events"
    recent = ["banner_id", "user_id", "event_ts", "event_id"]
    events = decode_events(message_stream(spark, source, max_files_per_trigger, fmt, options)) \
        .filter(F.col("user_id").isNotNull() & F.col("event_ts").isNotNull())

    def process(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        batch = batch.persist()
        try:
            prev_path = f"{state_path}/batch={batch_id - 1}"
            prior = s.read.parquet(prev_path) if batch_id > 0 and path_exists(s, prev_path) else None
            kept = clean.dedup_within_window(batch, ["banner_id", "user_id"], minutes=minutes, prior=prior)
            append_batch(kept.select(*_OUT_COLUMNS), table_path, ckpt, batch_id, "event_date")
            seen = batch.select(*recent) if prior is None else batch.select(*recent).unionByName(prior.select(*recent))
            top = seen.agg(F.max("event_ts")).collect()[0][0]
            if top is not None:
                horizon = F.lit(top).cast("timestamp_ntz") - F.expr(
                    f"INTERVAL {minutes + lateness_minutes} MINUTES")
                seen = clean.keep_first(seen.filter(F.col("event_ts") >= horizon), recent[:3], ["event_id"])
            lifecycle.write_layer(seen.withColumn("batch", F.lit(batch_id)), state_path, "batch")
            if batch_id >= 2:
                delete_path(s, f"{state_path}/batch={batch_id - 2}")
        finally:
            batch.unpersist()

    return run_batches(events, process, ckpt, available_now)


# B48 -----------------------------------------------------------------------
def ship_lines(spark: SparkSession, source: str, table_path: str, checkpoint: str | None = None,
               skip_line: str | None = None, available_now: bool = True, host: str | None = None,
               growing: bool = False):
    """Tail the lines of delimited files into log messages: ``topic``,
    ``value`` = JSON {message, fields: {log_type}} (+ host name when given),
    ``source_file``.  ``skip_line`` drops an exact line (e.g. the header).
    With ``growing`` lines that are added to a file later are shipped too, and
    rotated files go on (``sources.growing``); else a file is read once."""
    if growing:
        lines = growing_lines(spark, source).select("value", "source_file")
    else:
        lines = spark.readStream.format("text").load(source) \
            .select("value", F.col("_metadata.file_path").alias("source_file"))
    if skip_line is not None:
        lines = lines.filter(F.col("value") != F.lit(skip_line))
    parts = [F.col("value").alias("message"), F.struct(F.lit(LOG_TYPE).alias("log_type")).alias("fields")]
    if host:
        parts.append(F.struct(F.lit(host).alias("name")).alias("host"))
    msgs = lines.select(F.lit(LOG_TOPIC).alias("topic"), F.to_json(F.struct(*parts)).alias("value"),
                        F.col("value").alias("message"), "source_file")
    return append_stream(msgs, table_path, checkpoint or new_scratch(spark, "checkpoint-lines"), available_now)
