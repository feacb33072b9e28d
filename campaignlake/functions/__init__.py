"""Column expressions and header helpers."""

from campaignlake.functions.columns import (  # noqa: F401
    ACTION_WEIGHTS, BID_DEFAULT, BID_HIGH, BID_LOW, action_revenue, blank_safe_date, epoch_micros,
    event_identity, half_up_ratio, instant_to_ntz, is_blank, ntz_to_instant, null_if_blank_text,
    parse_decimal_comma, parse_dotted_date, parse_event_time, recommend_bid, safe_ratio,
)
from campaignlake.functions.names import clean_name, clean_names  # noqa: F401
