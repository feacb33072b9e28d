"""Entity specs: declared columns, renames, keys and partition column.

Raw entities arrive as text (delimited files) or JSON; ``conform_entity``
turns them into the typed columns declared here.  Dictionary fields that need
their own parsing rules (budget with decimal comma, dotted dates, blank-safe
dates) stay text in the raw layer and are parsed in the operational layer.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class EntitySpec:
    name: str
    columns: tuple[tuple[str, str], ...]
    renames: dict[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    partition: str | None = None

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]


BANNER_EVENTS = EntitySpec(
    "banner_events",
    (("event_id", "string"), ("banner_id", "bigint"), ("campaign_id", "bigint"),
     ("user_id", "bigint"), ("event_ts", "timestamp_ntz"), ("placement", "string"),
     ("device_type", "string"), ("os", "string"), ("geo", "string"), ("is_clicked", "int")),
    renames={"timestamp": "event_ts", "event_timestamp": "event_ts"},
    key=("banner_id", "user_id", "event_ts"),
    partition="event_date",
)

INSTALLS = EntitySpec(
    "installs",
    (("user_id", "bigint"), ("install_timestamp", "timestamp_ntz"), ("source", "string")),
    key=("user_id", "install_timestamp"),
)

ACTIONS = EntitySpec(
    "fct_actions",
    (("user_id", "bigint"), ("session_start", "timestamp_ntz"), ("actions", "string")),
    key=("user_id", "session_start"),
)

CD_BANNER = EntitySpec(
    "cd_banner",
    (("banner_id", "bigint"), ("creative_type", "string"), ("message", "string"),
     ("size", "string"), ("target_audience_segment", "string")),
    key=("banner_id",),
)

CD_CAMPAIGN = EntitySpec(
    "cd_campaign",
    (("campaign_id", "bigint"), ("daily_budget", "string"), ("start_date", "string"),
     ("end_date", "string")),
    key=("campaign_id",),
)

CD_USER = EntitySpec(
    "cd_user",
    (("user_id", "bigint"), ("segment", "string"), ("tariff", "string"),
     ("date_create", "string"), ("date_end", "string")),
    key=("user_id",),
)

ENTITIES = {s.name: s for s in (BANNER_EVENTS, INSTALLS, ACTIONS, CD_BANNER, CD_CAMPAIGN, CD_USER)}

# JSON message contract of the banner topic: event_ts is text on the wire.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("banner_id", T.LongType()),
    T.StructField("campaign_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_ts", T.StringType()),
    T.StructField("placement", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("geo", T.StringType()),
    T.StructField("is_clicked", T.IntegerType()),
])

# Column order of the daily campaign mart.
MART_COLUMNS = ("campaign_id", "date", "impressions", "clicks", "ctr", "installs",
                "conversions", "revenue", "cpc", "cpm", "conversion_rate", "processing_date")

FEATURE_COLUMNS = ("user_id", "snapshot_date", "impressions_7d", "clicks_7d", "actions_7d",
                   "recency_days", "device_type", "os", "segment", "tariff")
