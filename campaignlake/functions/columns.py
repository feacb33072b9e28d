"""Column expressions shared by the jobs.

All of them are built-in Spark expressions (whole-stage codegen, no Python
per row).  Functions take column names or ``Column`` objects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's business rules verbatim.
# Revenue per action (the misspelling "tarrif_switch" is data, keep it).
ACTION_WEIGHTS = (
    ("first_order", 100),
    ("tarrif_switch", 50),
    ("registration", 10),
)
# Bid recommendation labels and the probability threshold.
BID_HIGH = "high_spend +20%"
BID_LOW = "low_active стандарт"
BID_DEFAULT = "стандарт"
BID_HIGH_WORDS = ("high", "spend")
BID_LOW_WORDS = ("low", "active")
BID_PROBABILITY_THRESHOLD = 0.5
# Words that mean "no value" in delivered text.
NULL_WORDS = ("", "NULL")
# Date format of the campaign dictionary.
DOTTED_DATE_FORMAT = "dd.MM.yyyy"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def action_revenue(actions="actions") -> Column:
    """Revenue weight of one action; unknown or blank actions weigh 0."""
    a = _c(actions)
    expr = None
    for name, weight in ACTION_WEIGHTS:
        expr = (F.when(a == name, F.lit(weight)) if expr is None
                else expr.when(a == name, F.lit(weight)))
    return expr.otherwise(F.lit(0))


def is_blank(col) -> Column:
    """NULL or only whitespace (the TRIM form of the blank-action filter)."""
    c = _c(col)
    return c.isNull() | (F.trim(c) == "")


def null_if_blank_text(col) -> Column:
    """Blank text or the word NULL (any case) becomes NULL, else unchanged."""
    c = _c(col)
    return F.when(F.upper(F.trim(c)).isin(*NULL_WORDS), F.lit(None)).otherwise(c)


def parse_decimal_comma(col) -> Column:
    """'175071,43' or ' 95601.86 ' -> double; unparsable -> NULL."""
    return F.regexp_replace(F.trim(_c(col)), ",", ".").try_cast("double")


def parse_dotted_date(col) -> Column:
    """'01.02.2025' -> date; blank or unparsable -> NULL."""
    return F.try_to_date(F.nullif(F.trim(_c(col)), F.lit("")), DOTTED_DATE_FORMAT)


def blank_safe_date(col) -> Column:
    """ISO date text -> date; blank, the word NULL or unparsable -> NULL."""
    return F.try_to_date(null_if_blank_text(F.trim(_c(col))))


def parse_event_time(col) -> Column:
    """ISO timestamp text ('T' or space) -> TIMESTAMP_NTZ; bad text -> NULL.

    The cast is independent of the session time zone, so results agree with
    an external engine that stores naive timestamps.
    """
    return F.trim(_c(col)).try_cast("timestamp_ntz")


_DAY_US = 86_400_000_000


def epoch_micros(col, type_name: str = "timestamp_ntz") -> Column:
    """Microseconds since 1970-01-01 00:00.  For TIMESTAMP_NTZ this is the
    wall clock read as UTC, built from calendar fields so that it does not
    depend on the session time zone (no DST gaps or folds)."""
    c = _c(col)
    if type_name == "timestamp":
        return F.unix_micros(c)
    return (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(_DAY_US)
            + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(c).cast("bigint") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint"))


def ntz_to_instant(col) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP, reading the wall clock as UTC."""
    return F.timestamp_micros(epoch_micros(col))


def instant_to_ntz(col) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ as the UTC wall clock (inverse of ``ntz_to_instant``)."""
    us = F.unix_micros(_c(col))
    rem = F.pmod(us, F.lit(_DAY_US))
    days = ((us - rem) / F.lit(_DAY_US)).cast("int")
    secs = (rem / F.lit(1_000_000.0)).cast("decimal(18,6)")
    return F.date_from_unix_date(days).cast("timestamp_ntz") + \
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def half_up_ratio(num: str, den: str, scale: int) -> Column:
    """Exact half-up rounding of num/den to ``scale`` places.

    ``num`` and ``den`` are SQL expressions of non-negative integers.  Integer
    arithmetic avoids the tie differences of double ``round`` between engines;
    the result is a double.
    """
    m = 10 ** scale
    return F.expr(f"(CAST(({num}) AS BIGINT) * {2 * m} + CAST(({den}) AS BIGINT))"
                  f" div (2 * CAST(({den}) AS BIGINT))") / F.lit(float(m))


def safe_ratio(num: str, den: str, scale: int) -> Column:
    """``half_up_ratio`` when the divisor is positive, else 0.0 (never NULL)."""
    return F.when(F.expr(f"({den}) > 0"), half_up_ratio(num, den, scale)).otherwise(F.lit(0.0))


def recommend_bid(segment="segment", probability="probability_click") -> Column:
    """Bid rule.  A NULL segment is treated as 'default'; order matters:
    high words or a probability >= 0.5 win over low words."""
    seg = F.lower(F.trim(F.coalesce(_c(segment), F.lit("default"))))
    p = _c(probability)
    high = seg.contains(BID_HIGH_WORDS[0]) | seg.contains(BID_HIGH_WORDS[1]) | \
        (F.coalesce(p >= BID_PROBABILITY_THRESHOLD, F.lit(False)))
    low = seg.contains(BID_LOW_WORDS[0]) | seg.contains(BID_LOW_WORDS[1])
    return (F.when(high, F.lit(BID_HIGH))
            .when(low, F.lit(BID_LOW))
            .otherwise(F.lit(BID_DEFAULT)))


def event_identity(banner_id="banner_id", user_id="user_id", event_ts="event_ts") -> Column:
    """Deterministic event id: sha-256 of 'banner_user_timestamp', a NULL part
    being written as '~'.

    The timestamp is rendered with an explicit microsecond format so that the
    text does not depend on engine defaults.
    """
    ts_text = F.date_format(_c(event_ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    parts = (_c(banner_id).cast("string"), _c(user_id).cast("string"), ts_text)
    return F.sha2(F.concat_ws("_", *[F.coalesce(p, F.lit("~")) for p in parts]), 256)
