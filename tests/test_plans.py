"""Plan-shape guards for the scale design (checked on the physical plans)."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from campaignlake.operators import clean, features, marts
from campaignlake.plans.queries_core import ods_banners
from campaignlake.sources import domain as D
from tests.conftest import SF_SMALL


def _explain(df) -> str:
    """The formatted plan text (untruncated pushed filters), as printed by explain."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
        df.explain("formatted")
    return buf.getvalue()


def test_dedup_combines_before_the_shuffle(spark):
    plan = _explain(ods_banners(spark, SF_SMALL))
    physical = plan[plan.index("== Physical Plan =="):]
    # a partial aggregate (map-side combine) of the min(struct) sits below the exchange
    assert re.search(r"partial_min\(", physical)
    assert "Window" not in physical


def test_mart_has_no_full_outer_sort_merge_join_and_pushes_filters(spark):
    b = ods_banners(spark, SF_SMALL)
    mart = marts.campaign_daily_full(b, D.raw_installs(spark, SF_SMALL), D.raw_actions(spark, SF_SMALL), "2024-02-01")
    plan = _explain(mart)
    physical = plan[plan.index("== Physical Plan =="):]
    assert "FullOuter" not in physical
    assert "CountDistinct" not in physical and "count(distinct" not in physical.lower()
    assert "PushedFilters: [In(event_type, [click,view])]" in physical or \
        re.search(r"PushedFilters: \[.*In\(event_type, \[click,view\]\)", physical)


def test_feature_window_reaches_the_scan(spark):
    f = features.user_activity_7d(ods_banners(spark, SF_SMALL), "2024-01-15")
    physical = _explain(f)
    assert re.search(r"GreaterThanOrEqual\(ts,2024-01-08T00:00\)", physical)
    assert re.search(r"LessThan\(ts,2024-01-15T00:00\)", physical)


def test_window_rule_is_partitioned_by_time_bucket(spark):
    raw = clean.drop_null_key(D.raw_banner_events_with_near_copies(spark, SF_SMALL), "user_id")
    physical = _explain(clean.dedup_within_window(raw))
    m = re.search(r"Window \[.*?\], \[([^\]]*)\]", physical)
    assert m and "_bucket" in m.group(1)


def test_window_context_is_one_row_per_bucket(spark):
    raw = clean.drop_null_key(D.raw_banner_events_with_near_copies(spark, SF_SMALL), "user_id")
    before, after = _explain(clean.keep_first(raw, ["banner_id", "user_id", "event_ts"])), _explain(clean.dedup_within_window(raw))
    context = re.search(r"partial_max\(.*", after)
    assert context and "event_ts" in context[0] and "placement" not in context[0]  # times only, combined before the shuffle
    # no row is sent twice: the only explode is the one of the input, once for each use
    assert after.count("explode(") <= 2 * before.count("explode(")


def test_upsert_reads_only_the_touched_days(spark):
    from campaignlake.operators import lifecycle
    from campaignlake.session import new_scratch
    df = spark.range(0, 300).selectExpr("id AS campaign_id", "date_add(DATE'2025-01-01', CAST(id % 30 AS INT)) AS date", "id AS v")
    path = lifecycle.write_layer(df, new_scratch(spark, "t-upsert"), "date")
    table = spark.read.parquet(path)
    days = lifecycle.partition_values(df.where("date = DATE'2025-01-03'"), "date")
    plan = _explain(marts.upsert_rows(table.where(lifecycle.in_partitions("date", days)), df))
    assert "2025-01-03" in plan[plan.index("PartitionFilters"):].split("\n")[0]
    upd = df.where("date = DATE'2025-01-03'").withColumn("v", F.lit(-1).cast("bigint"))
    lifecycle.upsert_table(spark, path, upd)
    out = spark.read.parquet(path)
    assert out.count() == 300 and out.where("v = -1").count() == 10


def test_partitioned_writes_are_rebalanced(spark):
    from campaignlake.operators.lifecycle import clustered_for_write
    df = clustered_for_write(ods_banners(spark, SF_SMALL), ["event_date"])
    assert "RebalancePartitions [event_date" in _explain(df)
    plain = ods_banners(spark, SF_SMALL).select("event_id")
    assert "RebalancePartitions" not in _explain(clustered_for_write(plain, []))


def test_no_query_plans_a_cross_join_or_python_udf(spark):
    from campaignlake.plans.catalog import QUERIES
    found = []
    for name, fn in QUERIES.items():
        if name in ("train_click_model", "score_users"):  # calling them trains a model
            continue
        text = _explain(fn(spark, SF_SMALL))
        found += [(name, p) for p in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                                      "ArrowEvalPython") if p in text]
    assert found == []
