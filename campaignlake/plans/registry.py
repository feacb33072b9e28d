"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` through the domain
projection (``sources.domain``) and runs the library operator over the whole
tables.  ``ORACLE`` holds the matching DuckDB SQL where the operator is
SQL-expressible.  Dates that would otherwise default to "today" are fixed
parameters so that results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from campaignlake.plans import oracle_sql as O

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


PROCESSING_DATE = O.PROCESSING_DATE
SNAPSHOT_DATE = O.SNAPSHOT_DATE
