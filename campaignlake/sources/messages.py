"""Message sources: bounded topic reads and JSON event decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake import schemas
from campaignlake.functions import columns as C


# B06 -----------------------------------------------------------------------
def read_messages(spark: SparkSession, source: str, fmt: str = "kafka",
                  options: dict[str, str] | None = None) -> DataFrame:
    """All messages of a topic from earliest to latest, as a frame with a
    ``value`` column.

    ``fmt="kafka"``: ``source`` is the topic; options must carry
    ``kafka.bootstrap.servers`` (the Kafka connector jar must be on the
    classpath).  ``fmt="text"``: ``source`` is a folder of newline-delimited
    messages (one message per line), the same shape without a broker.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        reader = (spark.read.format("kafka").option("subscribe", source)
                  .option("startingOffsets", "earliest").option("endingOffsets", "latest"))
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load()
    if fmt == "text":
        return spark.read.options(**opts).text(source)
    raise ValueError(f"unknown message format {fmt}")


# B07 -----------------------------------------------------------------------
def decode_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON banner messages -> typed columns + event_date.

    A message that is not JSON gives an all-NULL row; a field of the wrong
    type gives NULL in that field only; an unparsable event_ts gives NULL
    event_ts and event_date."""
    record = F.from_json(F.col(value_col).cast("string"), schemas.MESSAGE_SCHEMA)
    time = C.parse_event_time(record["event_ts"])
    fields = [(time if f == "event_ts" else record[f]).alias(f) for f in schemas.MESSAGE_SCHEMA.names]
    return messages.select(*fields, F.to_date(time).alias("event_date"))


# B10 -----------------------------------------------------------------------
def skip_if_empty(df: DataFrame) -> bool:
    """True when the frame has no rows (one short job: limit 1)."""
    return df.isEmpty()
