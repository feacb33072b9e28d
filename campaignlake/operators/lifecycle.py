"""Table lifecycle as Spark jobs: layered writes, upsert, compaction, tiering.

Tables are folders of Parquet partitioned by a DATE column.  Every rewrite
uses dynamic partition overwrite, so only the partitions present in the
written frame are replaced.  When a job rewrites partitions of the table it
reads, the new content is first written to a fresh folder (lineage cut,
restartable), then put in place.  Compaction and tiering keep a journal beside
the data (folders starting with '_', which readers skip), so that a run after
an interrupted one first brings the table back in order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import groupby

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.operators.marts import upsert_rows
from campaignlake.session import (delete_path, list_files, list_folders, new_scratch, path_exists, read_note, rename_path,
                                   write_note)

# Hot retention and the default file size target.
HOT_DAYS = 30
ROWS_PER_FILE = 5_000_000


# B50 -----------------------------------------------------------------------
def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] | str | None = None,
                mode: str = "overwrite", rows_per_file: int | None = None,
                rebalance: bool = True) -> str:
    """Create or replace a table; with ``partition_by`` only the partitions
    present in ``df`` are replaced (dynamic overwrite).

    A partitioned write is clustered by its partition columns with the
    ``rebalance`` hint first: without it every input task writes one file per
    day it touches (tasks x days small files); with it adaptive execution
    gives each day files of the advisory size and splits a very large day
    over several tasks."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if rebalance:
        df = clustered_for_write(df, cols)
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", str(rows_per_file))
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return path


def partition_folder(partition: str, value: object) -> str:
    """Name of the folder that holds a partition value."""
    return f"{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def replace_partitions(df: DataFrame, path: str, partition: str, values: Sequence) -> str:
    """``write_layer``, after which the partitions of ``values`` hold the rows
    of ``df`` and nothing else: those that ``df`` has no row of are removed."""
    spark = df.sparkSession
    folders = [f"{path}/{partition_folder(partition, v)}" for v in values]
    before = {f: set(list_files(spark, f)) for f in folders}
    write_layer(df, path, partition)
    for f, files in before.items():
        if files & set(list_files(spark, f)):  # a rewritten partition has new files only
            delete_path(spark, f)
    return path


def clustered_for_write(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """``df`` with the ``rebalance`` hint on the partition columns (if any)."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when it does not exist yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def stage(df: DataFrame, partition_by: Sequence[str] | str | None = None, name: str = "stage") -> DataFrame:
    """Write ``df`` to a fresh scratch folder and read it back (lineage cut)."""
    spark = df.sparkSession
    path = write_layer(df, new_scratch(spark, name), partition_by)
    return spark.read.parquet(path)


# B28 -----------------------------------------------------------------------
def partition_values(df: DataFrame, partition: str) -> list:
    """Distinct values of a DATE partition column (one per day; None first)."""
    return sorted((r[0] for r in df.select(partition).distinct().collect()), key=lambda v: (v is not None, v))


def in_partitions(partition: str, values: list) -> Column:
    """Literal partition filter, so that the scan reads these folders only."""
    known = [F.lit(str(v)).cast("date") for v in values if v is not None]
    hit = F.col(partition).isin(*known) if known else F.lit(False)
    return hit | F.col(partition).isNull() if None in values else hit


def upsert_table(spark: SparkSession, path: str, updates: DataFrame,
                 key: Sequence[str] = ("date", "campaign_id"), partition: str = "date") -> str:
    """INSERT ... ON CONFLICT (key) DO UPDATE on a partitioned table: only the
    partitions touched by ``updates`` are read and rewritten (their values are
    a literal partition filter).  Running it twice with the same updates gives
    the same table."""
    existing = read_table(spark, path)
    if existing is None:
        return write_layer(updates, path, partition)
    updates = stage(updates.select(*existing.columns), partition, "upsert-input")
    touched = existing.where(in_partitions(partition, partition_values(updates, partition)))
    return write_layer(stage(upsert_rows(touched, updates, key), partition, "upsert"), path, partition)


# B51 -----------------------------------------------------------------------
COMPACTED = "_compacted"    # new files on their way in
COMPACTION = "_compaction"  # journal: the files that they stand for
REPLACED = "_replaced"      # whole folders moved out by earlier versions


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Put a copied compaction in place, also after an interruption: exactly the
    files that were copied go, partition by partition, and their copies come in.
    A copy without its journal entry is unfinished and is thrown away."""
    for name in list_folders(spark, f"{path}/{REPLACED}"):
        if path_exists(spark, f"{path}/{name}"):
            delete_path(spark, f"{path}/{REPLACED}/{name}")
        else:
            rename_path(spark, f"{path}/{REPLACED}/{name}", f"{path}/{name}")
    delete_path(spark, f"{path}/{REPLACED}")
    old = read_note(spark, f"{path}/{COMPACTION}/copied")
    if old is not None:
        for folder, files in groupby(sorted(old), key=lambda f: f.rpartition("/")[0]):
            for f in files:
                delete_path(spark, f"{path}/{f}")
            for f in list_files(spark, f"{path}/{COMPACTED}/{folder}"):
                rename_path(spark, f"{path}/{COMPACTED}/{folder}/{f}", f"{path}/{folder}/{f}")
        delete_path(spark, f"{path}/{COMPACTION}")
    delete_path(spark, f"{path}/{COMPACTED}")


def copy_compacted(spark: SparkSession, path: str, partition: str, where: str | None = None,
                   rows_per_file: int = ROWS_PER_FILE) -> int:
    """First half of ``compact_partitions``: the files present now are copied
    into larger ones beside the table and noted.  Returns their number."""
    df = spark.read.parquet(path)
    files = list_files(spark, path)
    if where:
        folders = {partition_folder(partition, v) for v in partition_values(df.filter(where), partition)}
        files = [f for f in files if f.split("/")[0] in folders]
    if not files:
        return 0
    # exactly these files: rows that arrive meanwhile stay in files of their own
    sel = spark.read.schema(df.schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in files])
    rows = {r[0]: r[1] for r in sel.groupBy(partition).count().collect()}  # one per day
    pieces = {v: -(-n // rows_per_file) for v, n in rows.items()}
    large = [x for v, k in pieces.items() if k > 1 and v is not None for x in (F.lit(str(v)).cast("date"), F.lit(k))]
    spread = F.coalesce(F.try_element_at(F.create_map(*large), F.col(partition)), F.lit(1)) if large else F.lit(1)
    salted = (sel.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in df.columns if c != partition]), spread))
              .repartition(max(1, sum(pieces.values())), partition, "_salt").drop("_salt"))
    copy = write_layer(salted, f"{path}/{COMPACTED}", partition, rows_per_file=2 * rows_per_file, rebalance=False)
    got = spark.read.schema(df.schema).parquet(copy).count()
    if got != sum(rows.values()):
        raise RuntimeError(f"compaction copied {got} of {sum(rows.values())} rows of {path}; nothing was replaced")
    write_note(spark, f"{path}/{COMPACTION}/copied", files)
    return len(files)


def compact_partitions(spark: SparkSession, path: str, partition: str, where: str | None = None,
                       rows_per_file: int = ROWS_PER_FILE) -> str:
    """Rewrite the partitions that hold a row of ``where`` into files of about
    ``rows_per_file`` rows, each row being written once.  A partition with more rows than that
    is spread over several tasks by a hash salt, so one large day never lands
    in a single task.  A fixed list of files is copied beside the table, counted
    and noted; then these files go and the copies come in, so that rows appended
    meanwhile stay.  A run after an interrupted one ends it first."""
    finish_compaction(spark, path)
    copy_compacted(spark, path, partition, where, rows_per_file)
    finish_compaction(spark, path)
    return path


# B52 -----------------------------------------------------------------------
JOURNAL = "_tiering"
MOVE = "move"  # partition column of the cold table: one value per tiering run


def _finish_tiering(spark: SparkSession, path: str, cold_path: str) -> None:
    """After an interrupted run: a move whose rows are all in the cold table
    gets its hot files deleted; an unfinished move is taken back out of it."""
    done, begun = (read_note(spark, f"{cold_path}/{JOURNAL}/{x}") for x in ("copied", "begun"))
    if done is not None:
        for f in done[1:]:
            delete_path(spark, f"{path}/{f}")
    elif begun is not None:
        for month in list_folders(spark, cold_path):
            for day in list_folders(spark, f"{cold_path}/{month}") if month.startswith("month=") else []:
                delete_path(spark, f"{cold_path}/{month}/{day}/{MOVE}={begun[0]}")
    delete_path(spark, f"{cold_path}/{JOURNAL}")


def tier_hot_cold(spark: SparkSession, path: str, cold_path: str, partition: str, as_of: str,
                  hot_days: int = HOT_DAYS, ttl_days: int | None = None) -> tuple[str, str]:
    """Keep the last ``hot_days`` days (before ``as_of``) in the hot table;
    move older days to the cold table partitioned by month (yyyy-MM), day and
    move; with ``ttl_days`` drop cold days older than that.

    Every run adds a partition value of its own (``move``), so rows that come
    late for an archived day join it and nothing there is replaced.  Hot files
    are listed first, copied, counted and only then deleted; a journal beside
    the cold table lets the next run finish or take back an interrupted one."""
    _finish_tiering(spark, path, cold_path)
    df = read_table(spark, path)
    if df is not None:
        cold = df.filter(F.col(partition) < F.date_sub(F.lit(as_of).cast("date"), hot_days))
        days = set(partition_values(cold, partition))
        files = [f for f in list_files(spark, path) if f.split("/")[0] in {f"{partition}={d}" for d in days}]
        if files:
            move = f"{as_of}-{uuid.uuid4().hex[:8]}"
            write_note(spark, f"{cold_path}/{JOURNAL}/begun", [move])
            # exactly these files: rows that arrive meanwhile wait for the next run
            moved = spark.read.schema(df.schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in files])
            moved = moved.withColumn("month", F.date_format(partition, "yyyy-MM")).withColumn(MOVE, F.lit(move))
            write_layer(moved.select(*[c for c in df.columns if c != partition], "month", partition, MOVE),
                        cold_path, ["month", partition, MOVE])
            want = spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in files]).count()
            got = spark.read.parquet(cold_path).where(F.col(MOVE) == move).count()
            if got != want:
                raise RuntimeError(f"tiering copied {got} of {want} rows to {cold_path}; nothing was deleted")
            write_note(spark, f"{cold_path}/{JOURNAL}/copied", [move, *files])
            _finish_tiering(spark, path, cold_path)
    if ttl_days is not None:
        old = read_table(spark, cold_path)
        if old is not None:
            limit = F.date_sub(F.lit(as_of).cast("date"), ttl_days)
            expired = old.filter(F.col(partition) < limit).select("month", F.date_format(partition, "yyyy-MM-dd")) \
                .distinct().collect()
            for month, day in expired:
                delete_path(spark, f"{cold_path}/month={month}/{partition}={day}")
    return path, cold_path


# B40 -----------------------------------------------------------------------
def write_predictions(predictions: DataFrame, path: str) -> str:
    """Snapshot-partitioned prediction table; rewrites only that snapshot."""
    return write_layer(predictions, path, "snapshot_date")
