"""Hand-made fixture with computed goldens (see FIXTURES.md sections 2-3)."""

import datetime as dt

from pyspark.sql import functions as F


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


BANNER_ROWS = [
    # event_id, banner, campaign, user, ts, clicked
    ("e1", 1, 1, 10, "2025-02-01 10:00:00", 0),
    ("e2", 1, 1, 10, "2025-02-01 10:00:00", 0),
    ("e3", 2, 1, 10, "2025-02-01 10:05:00", 1),
    ("e4", 3, 2, 10, "2025-02-01 11:00:00", 0),
    ("e5", 1, 1, None, "2025-02-01 12:00:00", 1),
    ("e6", 1, 1, 11, "2025-02-02 09:00:00", 0),
    ("e7", 4, 1, 12, "2025-02-01 13:00:00", 0),
]

BANNER_DDL = ("event_id string, banner_id bigint, campaign_id bigint, user_id bigint, "
              "event_ts timestamp_ntz, placement string, device_type string, os string, geo string, "
              "is_clicked int")


def banners(spark):
    rows = [(e, b, c, u, ts(t), "site", "phone", "ios", "Москва", k) for e, b, c, u, t, k in BANNER_ROWS]
    return spark.createDataFrame(rows, BANNER_DDL).withColumn("event_date", F.to_date("event_ts"))


def installs(spark):
    rows = [(10, ts("2025-02-01 15:00:00"), "баннер"), (10, ts("2025-02-01 16:00:00"), "баннер"),
            (13, ts("2025-02-01 15:00:00"), "органика"), (None, ts("2025-02-01 17:00:00"), "другое")]
    return spark.createDataFrame(rows, "user_id bigint, install_timestamp timestamp_ntz, source string")


def actions(spark):
    rows = [(10, ts("2025-02-01 15:30:00"), "first_order"), (10, ts("2025-02-01 15:10:00"), "registration"),
            (11, ts("2025-02-02 10:00:00"), ""), (11, ts("2025-02-02 10:01:00"), "other"),
            (12, ts("2025-02-01 18:00:00"), "tarrif_switch"), (12, ts("2025-02-03 18:00:00"), "first_order")]
    return spark.createDataFrame(rows, "user_id bigint, session_start timestamp_ntz, actions string")


def campaigns_raw(spark):
    rows = [("1", "175071,43", "01.02.2025", "17.03.2025"), ("2", "95601.86", "01.02.2025", "17.03.2025"),
            ("3", "166617.61", "01.02.2025", "17.03.2025")]
    return spark.createDataFrame(rows, "campaign_id string, daily_budget string, start_date string, "
                                       "end_date string")


def users_raw(spark):
    rows = [("10", "high_spend", "basic", "2024-01-01", ""), ("11", "low_active", "basic", "2024-01-01", ""),
            ("11", "low_active", "basic", "2024-01-01", ""), ("12", None, None, "", "NULL")]
    return spark.createDataFrame(rows, "user_id string, segment string, tariff string, date_create string, "
                                       "date_end string")
