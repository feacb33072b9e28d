"""Every registered query with an oracle against DuckDB on sf0.001, plus the
driver contract."""

import datetime as dt
import math
from collections import Counter

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _bag(rows, cols):
    return Counter(tuple(_norm(r[c]) for c in cols) for r in rows)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in sdf.schema.fields:
        assert _TYPES.get(f.dataType.simpleString()) == duck_types[f.name], (f.name, f.dataType, duck_types[f.name])
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert _bag(srows, cols) == _bag(drows, cols)


def test_contract(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["campaign_id", "date", "impressions", "clicks", "ctr", "installs", "conversions",
                          "revenue", "cpc", "cpm", "conversion_rate", "processing_date"]
