"""BI read queries on the daily campaign mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.functions import columns as C

# The dashboard row cap and the preview size.
ROW_LIMIT = 5000
PREVIEW_ROWS = 10
TABLE_COLUMNS = ("campaign_id", "date", "impressions", "clicks", "ctr", "installs",
                 "conversions", "revenue", "cpc", "cpm", "conversion_rate")


# B41 -----------------------------------------------------------------------
def ctr_by_campaign(mart: DataFrame) -> DataFrame:
    """Per campaign: summed impressions/clicks, ctr as the ratio of sums in
    percent (4 places) and the mean of the daily ctr values (4 places)."""
    agg = mart.groupBy("campaign_id").agg(
        F.sum("impressions").cast("bigint").alias("impressions"),
        F.sum("clicks").cast("bigint").alias("clicks"),
        F.sum(F.round(F.col("ctr") * 10000).cast("bigint")).alias("_ctr_units"),
        F.count(F.lit(1)).alias("days"))
    return agg.select(
        "campaign_id", "impressions", "clicks",
        C.safe_ratio("clicks * 100", "impressions", 4).alias("ctr"),
        (C.safe_ratio("_ctr_units", "days", 0) / F.lit(10000.0)).alias("avg_daily_ctr"),
        "days")


# B42 -----------------------------------------------------------------------
def traffic_by_day(mart: DataFrame) -> DataFrame:
    return mart.groupBy("date").agg(F.sum("impressions").cast("bigint").alias("impressions"),
                                    F.sum("clicks").cast("bigint").alias("clicks"))


# B43 -----------------------------------------------------------------------
def campaign_table(mart: DataFrame, limit: int = ROW_LIMIT) -> DataFrame:
    """The dashboard table: fixed columns, ordered, capped (the cap is the
    feature: it is the dashboard's row limit)."""
    return mart.select(*TABLE_COLUMNS).orderBy("date", "campaign_id").limit(limit)


# B44 -----------------------------------------------------------------------
def preview(df: DataFrame, n: int = PREVIEW_ROWS, order: tuple[str, ...] | None = None) -> DataFrame:
    """First ``n`` rows, in a fixed order so that the sample is repeatable."""
    cols = list(order) if order else list(df.columns)
    return df.orderBy(*cols).limit(n)
