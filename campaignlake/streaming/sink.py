"""Appending micro-batches to plain Parquet tables.

The table keeps the layout of a batch-written one (partition folders, no
stream log of its own), so rows from both stand side by side and compaction
and tiering may rewrite it.  A micro-batch is written beside the table and its
files are then moved in under names that carry the stream and the batch; notes
in the checkpoint folder say which batches began and which are in.  A replayed
batch is skipped if it is in, else what it left is removed first.  (A table
must not be compacted between a crash in the middle of a batch and the restart
of its stream.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from campaignlake.session import delete_path, list_files, path_exists, rename_path, write_note

DEFAULT_INTERVAL = "60 seconds"


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """A stateful stream runs its batches without adaptive execution, where the
    ``rebalance`` hint does nothing: every state partition would write a file
    into every day.  The write of a batch is a plan of its own (the state's
    partitions stay as they are), so it may be adaptive."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def append_batch(df: DataFrame, table_path: str, checkpoint: str, batch_id: int, partition_by: str | None = None) -> None:
    """Add ``df`` to the table exactly once for this stream and batch."""
    spark = df.sparkSession
    stream = hashlib.sha256(f"{checkpoint} {table_path}".encode()).hexdigest()[:10]
    notes, prefix = f"{checkpoint}/appended/{stream}", f"part-{stream}-{batch_id:010d}-"
    if path_exists(spark, f"{notes}/in-{batch_id}"):
        return
    staged = f"{table_path}/_incoming/{stream}-{batch_id}"
    delete_path(spark, staged)
    if path_exists(spark, f"{notes}/begun-{batch_id}"):
        for f in list_files(spark, table_path):
            if f.rsplit("/", 1)[-1].startswith(prefix):
                delete_path(spark, f"{table_path}/{f}")
    write_note(spark, f"{notes}/begun-{batch_id}", [table_path])
    with _adaptive(spark):  # the hint is resolved at once
        writer = (df.hint("rebalance", partition_by) if partition_by else df).write
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(staged)
    for i, f in enumerate(list_files(spark, staged)):
        folder = f.rpartition("/")[0]
        rename_path(spark, f"{staged}/{f}", "/".join(x for x in (table_path, folder, f"{prefix}{i:05d}.parquet") if x))
    write_note(spark, f"{notes}/in-{batch_id}", [table_path])
    delete_path(spark, staged)
    for old in ("begun", "in"):
        delete_path(spark, f"{notes}/{old}-{batch_id - 2}")


def run_batches(df: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool,
                interval: str = DEFAULT_INTERVAL):
    """Start ``process`` on every micro-batch; waits for the end with ``available_now``."""
    w = df.writeStream.outputMode("append").foreachBatch(process).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
    if available_now:
        q.awaitTermination()
    return q


def append_stream(df: DataFrame, table_path: str, checkpoint: str, available_now: bool, partition_by: str | None = None,
                  interval: str = DEFAULT_INTERVAL):
    """Append a stream to a table (see the module text)."""
    return run_batches(df, lambda batch, n: append_batch(batch, table_path, checkpoint, n, partition_by), checkpoint,
                       available_now, interval)
