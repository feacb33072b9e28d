"""Delimited-file ingest: read, clean the header, conform, split malformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlake.functions import columns as C
from campaignlake.functions.names import clean_names
from campaignlake.schemas import EntitySpec

CORRUPT = "_corrupt_record"
# Fixed values of the delivered files: separator and quote.
DEFAULT_SEP = ";"
DEFAULT_QUOTE = '"'


# B01 -----------------------------------------------------------------------
def read_delimited(spark: SparkSession, path: str, schema: str | None = None,
                   sep: str = DEFAULT_SEP, quote: str = DEFAULT_QUOTE,
                   encoding: str = "UTF-8") -> DataFrame:
    """Headered delimited text, every column STRING, empty field -> NULL.

    Without ``schema`` the header names the columns (a UTF-8 byte-order mark
    is dropped by the reader), and a file of a folder whose header differs
    from the first one's is an error when it is read.  With ``schema`` (DDL
    text of STRING columns, positional) rows with too few or too many fields
    keep their raw text in ``_corrupt_record`` instead of being padded or cut
    silently.
    """
    def reader():
        return (spark.read.option("header", True).option("sep", sep).option("quote", quote)
                .option("encoding", encoding).option("inferSchema", False))

    if schema is not None:
        return (reader().schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    first = reader().csv(path)
    # every file's header is held against this one, whatever columns are read
    return reader().schema(first.schema).option("enforceSchema", False).option("columnPruning", False).csv(path)


def read_lines_checked(spark: SparkSession, path: str, sep: str = DEFAULT_SEP, quote: str = DEFAULT_QUOTE) -> DataFrame:
    """Headered delimited text with cleaned column names plus ``_corrupt_record``
    (see ``split_malformed``); a file whose header differs is an error."""
    names = spark.read.option("header", True).option("sep", sep).option("quote", quote).csv(path).columns
    kept = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    rows = (spark.read.schema(kept).option("header", True).option("sep", sep).option("quote", quote)
            .option("enforceSchema", False).option("columnPruning", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return rows.toDF(*clean_names(names), CORRUPT)


# B02 -----------------------------------------------------------------------
def normalize_columns(df: DataFrame) -> DataFrame:
    """Clean every header name (see ``functions.names.clean_name``); metadata only."""
    return df.toDF(*clean_names(df.columns))


# B03 -----------------------------------------------------------------------
def conform_entity(df: DataFrame, spec: EntitySpec, strict: bool = True) -> DataFrame:
    """Rename to the entity's names and cast to its declared types.

    Casts never fail: unparsable ids, numbers and timestamps become NULL.
    A declared column that is missing is an error (``strict``) or NULL.
    """
    renames = {k: v for k, v in spec.renames.items() if k in df.columns and v not in df.columns}
    if renames:
        df = df.withColumnsRenamed(renames)
    missing = [c for c in spec.names if c not in df.columns]
    optional = {"event_id"}
    if strict and [c for c in missing if c not in optional]:
        raise ValueError(f"{spec.name}: missing columns {missing} in {df.columns}")
    cols = []
    for name, typ in spec.columns:
        if name not in df.columns:
            cols.append(F.lit(None).cast(typ).alias(name))
        elif typ.startswith("timestamp"):
            cols.append(C.parse_event_time(F.col(name).cast("string")).alias(name))
        elif typ == "string":
            cols.append(F.col(name).cast("string").alias(name))
        else:
            cols.append(F.trim(F.col(name).cast("string")).try_cast(typ).alias(name))
    return df.select(*cols)


# B04 -----------------------------------------------------------------------
def split_malformed(df: DataFrame, flag_col: str | None = "is_clicked") -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) from a frame read with a schema.

    Quarantine: rows whose field count differs from the schema, as parsed
    (missing fields NULL, surplus cut) plus their raw text in ``raw_line``.
    Good rows: the rest, with a click flag that is not all digits set to
    NULL."""
    # the flag depends on all fields: naming them keeps every action (a bare count too) reading them
    whole = F.length(F.concat_ws("", *[c for c in df.columns if c != CORRUPT])) >= 0
    bad = df.filter(whole & F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "raw_line")
    good = df.filter(whole & F.col(CORRUPT).isNull()).drop(CORRUPT)
    if flag_col and flag_col in good.columns:
        flag = F.trim(F.col(flag_col))
        good = good.withColumn(flag_col, F.when(flag.rlike("^[0-9]+$"), flag))
    return good, bad


# B09 -----------------------------------------------------------------------
def take_first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Optional repeatable row cap for demo loads: 0 keeps everything."""
    return df if not n else df.orderBy(*order).limit(n)


def ingest_delimited(spark: SparkSession, path: str, spec: EntitySpec, sep: str = DEFAULT_SEP) -> DataFrame:
    """B01 -> B02 -> B03 for one entity file (or folder of files)."""
    return conform_entity(normalize_columns(read_delimited(spark, path, sep=sep)), spec)
