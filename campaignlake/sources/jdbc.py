"""JDBC tables: partitioned read, truncating overwrite, batched insert.

No database is started by this package; these are thin, parameter-checked
wrappers over Spark's JDBC source for deployments that have one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The batch size of bulk inserts.
INSERT_BATCH_SIZE = 5000


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


# B08 -----------------------------------------------------------------------
def jdbc_read(spark: SparkSession, options: dict[str, str], partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    """Read a table; with a numeric partition column and bounds the read is
    split into ``num_partitions`` parallel range queries (not one task)."""
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", str(fetch_size))
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def jdbc_write(df: DataFrame, options: dict[str, str], mode: str = "overwrite",
               truncate: bool = True, batch_size: int = INSERT_BATCH_SIZE,
               num_partitions: int | None = None) -> None:
    """Overwrite keeping the table definition (TRUNCATE) or append, in
    batches of ``batch_size`` rows, with at most ``num_partitions`` parallel
    connections."""
    writer = (df.write.format("jdbc").options(**options).mode(mode)
              .option("truncate", str(truncate).lower()).option("batchsize", str(batch_size)))
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.save()
