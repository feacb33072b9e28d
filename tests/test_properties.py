"""Property tests: operators against brute force on random small inputs."""

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from campaignlake.functions import columns as C
from campaignlake.operators import clean
from tests import fixtures as X

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
BASE = dt.datetime(2025, 2, 1, 23, 0)

events = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 1), st.integers(0, 180), st.integers(0, 59)),
    min_size=1, max_size=40)


def _rows(evs):
    return [(f"e{i:03d}", b, 1, u, BASE + dt.timedelta(minutes=m, seconds=s), "site", "phone", "ios", "g", 0)
            for i, (b, u, m, s) in enumerate(evs)]


@SETTINGS
@given(evs=events, minutes=st.sampled_from([1, 5, 10]))
def test_window_dedup_equals_sequential_rule(spark, evs, minutes):
    rows = _rows(evs)
    df = spark.createDataFrame(rows, X.BANNER_DDL)
    got = {r.event_id for r in clean.dedup_within_window(df, minutes=minutes).collect()}
    want, last = set(), {}
    for r in sorted(rows, key=lambda r: (r[1], r[3], r[4], r[0])):
        prev = last.get((r[1], r[3]))
        if prev is None or r[4] - prev >= dt.timedelta(minutes=minutes):
            want.add(r[0])
        last[(r[1], r[3])] = r[4]
    assert got == want


@SETTINGS
@given(evs=events)
def test_keep_first_equals_row_number(spark, evs):
    rows = _rows([(b, u, m % 3, 0) for b, u, m, _ in evs])
    df = spark.createDataFrame(rows, X.BANNER_DDL)
    got = sorted(r.event_id for r in clean.dedup_events(df).collect())
    best = {}
    for r in rows:
        k = (r[1], r[3], r[4])
        if k not in best or r[0] < best[k][0]:
            best[k] = r
    assert got == sorted(r[0] for r in best.values())


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**6)), min_size=1, max_size=20),
       scale=st.sampled_from([0, 2, 4]))
def test_half_up_ratio_is_exact(spark, pairs, scale):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r[0] for r in df.select(C.safe_ratio("n", "d", scale)).collect()]
    m = 10 ** scale
    want = []
    for n, d in pairs:
        if d == 0:
            want.append(0.0)
            continue
        q = Fraction(n, d) * m
        want.append(float(int(q + Fraction(1, 2))) / m)
    assert got == want


def _bid_rule(segment, p):
    seg = "default" if segment is None else segment
    seg = seg.strip().lower()
    if "high" in seg or "spend" in seg or (p is not None and p >= 0.5):
        return "high_spend +20%"
    if "low" in seg or "active" in seg:
        return "low_active стандарт"
    return "стандарт"


@SETTINGS
@given(rows=st.lists(st.tuples(
    st.one_of(st.none(), st.sampled_from(["high_spend", " Low_Active ", "youth", "HIGH", "inactive", "default",
                                          "automobile", "", "spender"])),
    st.one_of(st.none(), st.sampled_from([0.0, 0.1, 0.4999, 0.5, 0.7, 1.0]))), min_size=1, max_size=30))
def test_bid_rule_matches_python_rule(spark, rows):
    df = spark.createDataFrame(rows, "segment string, probability_click double")
    got = [r[0] for r in df.select(C.recommend_bid()).collect()]
    assert got == [_bid_rule(s, p) for s, p in rows]


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 10**7), st.integers(0, 99), st.sampled_from([",", "."]),
                               st.sampled_from(["", " ", "  "])), min_size=1, max_size=20))
def test_budget_parsing_matches_python(spark, vals):
    texts = [f"{pad}{w}{sep}{c:02d}{pad}" for w, c, sep, pad in vals]
    df = spark.createDataFrame([(t,) for t in texts], "b string")
    got = [r[0] for r in df.select(C.parse_decimal_comma("b")).collect()]
    assert got == [float(t.strip().replace(",", ".")) for t in texts]
