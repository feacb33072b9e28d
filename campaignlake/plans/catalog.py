"""All registered queries: importing this module registers every query."""

from campaignlake.plans import queries_core, queries_ingest, queries_ml, queries_streams  # noqa: F401
from campaignlake.plans.registry import ORACLE, QUERIES  # noqa: F401
