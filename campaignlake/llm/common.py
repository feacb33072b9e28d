"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_scratch

MAX_ONE_ROW_PER_PARTITION = 1_000_000  # rows of a table that holds one row per input partition

TEXTS_PER_BATCH, BYTES_PER_BATCH = 2000, "4m"  # of rows that go to Python at once


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python a few MB at a time (by default 10,000 rows): a task
    holds a batch several times over, on both sides.  Set for the session, as a
    frame is planned when its caller runs it; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: lineage ends here, and a
    lost executor costs a read, not a recomputation."""
    spark = df.sparkSession
    path = new_scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, most: int) -> DataFrame:
    """``df`` with a broadcast hint when it holds at most ``most`` rows (counted
    first); beyond that the planner's own join is used."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def first_by_hash(df: DataFrame, n: int, by: tuple = (), ties: tuple = ()) -> DataFrame:
    """The first ``n`` rows (of each group ``by``) in the order of doc_id's hash,
    doc_id and ``ties``.  Rows are counted by ranges of the hash first
    (combined in every task); only rows up to the range in which the n-th one
    lies are ranked, so neither a group nor a task brings more than these."""
    hashed = df.withColumn("_hash", F.xxhash64("doc_id")).withColumn("_range", F.shiftright("_hash", 48))
    counts = hashed.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).where(F.col("_before") < n)
    last = counts.groupBy(*by).agg(F.max("_range").alias("_last"))
    order = ["_hash", "doc_id", *ties]
    if not by:
        upto = last.first()[0]
        near = hashed.where(F.col("_range") <= F.lit(upto)) if upto is not None else hashed.where(F.lit(False))
        return near.orderBy(*order).limit(n).select(*df.columns)
    near = hashed.join(bounded_broadcast(last, MAX_ONE_ROW_PER_PARTITION), list(by)).where("_range <= _last")
    near = near.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return near.where(F.col("_rank") <= n).select(*df.columns)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (the held-out rule)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def crc_remainder(value: object, divisor: int) -> int:
    """The same rule for one value, outside Spark."""
    return zlib.crc32(str(value).encode()) % divisor


def mix64(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64 (fixed constants), elementwise."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long a, long b); the
    component is its smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every
    step is a grouped minimum and a join, a step's edges are at most the
    previous ones, and the number of steps grows with the logarithm of the
    longest chain.  Each step is written to the scratch folder.  Self links and
    repeated links are harmless; no link gives an empty table."""
    def directed(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    # a > b throughout
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    before = state(now)
    while before[0]:
        both = directed(now)
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        large = written(large, "links")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        now = written(small, "links")
        after = state(now)
        if after == before:
            break
        before = after
    tips = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return tips.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
