"""Correctness when one key holds a third of the rows (hot copy group, hot user)."""

import duckdb
from pyspark.sql import functions as F

from campaignlake.operators import clean, marts
from campaignlake.plans import oracle_sql as O
from campaignlake.sources import domain as D
from tests.conftest import SF_SMALL


def _skewed_raw(spark):
    raw = D.raw_banner_events(spark, SF_SMALL)
    n = raw.count()
    # a third of the rows of the hot user: re-assign every third impression
    hot_user = raw.withColumn("user_id", F.when(F.col("banner_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    # plus one group of exact copies as large as everything else
    one = hot_user.filter(F.col("user_id").isNotNull()).orderBy("event_id").limit(1)
    copies = one.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(n // 2 - 1)))) \
        .withColumn("event_id", F.concat(F.col("event_id"), F.lit("-copy-"), F.col("_c").cast("string"))) \
        .drop("_c")
    return hot_user.unionByName(copies), n


def test_clean_and_mart_under_skew_match_sql(spark):
    raw, n = _skewed_raw(spark)
    assert raw.count() >= n + n // 2
    installs, actions = D.raw_installs(spark, SF_SMALL), D.raw_actions(spark, SF_SMALL)
    ods = clean.clean_banner_events(raw)
    mart = marts.campaign_daily_full(ods, installs, actions, "2024-02-01")
    got = sorted(tuple(r) for r in mart.collect())

    con = duckdb.connect()
    con.register("raw_b", raw.toPandas())
    con.register("i", installs.toPandas())
    con.register("a", actions.toPandas())
    sql = (f"WITH b AS ({O.clean_banners('raw_b')}), {O.mart_ctes('b', 'i', 'a')} "
           f"{O.mart_select('c', '2024-02-01')}")
    rel = con.sql(sql)
    cols = rel.columns
    want = sorted(tuple(dict(zip(cols, r))[c] for c in mart.columns) for r in rel.fetchall())
    assert len(got) == len(want)
    assert [tuple(str(v) for v in r) for r in got] == [tuple(str(v) for v in r) for r in want]
    # the copy group collapsed to one row
    assert ods.count() == con.sql("SELECT COUNT(*) FROM (SELECT DISTINCT banner_id, user_id, event_ts "
                                  "FROM raw_b WHERE user_id IS NOT NULL)").fetchall()[0][0]
