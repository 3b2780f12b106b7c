from tidewatch.functions.columns import (
    LARGEST_AMOUNT,
    contains_pattern,
    exact,
    exact_total,
    iso_utc,
    json_with,
    money,
    plain_number,
    to_millis,
    tumbling,
)

__all__ = [
    "LARGEST_AMOUNT",
    "contains_pattern",
    "exact",
    "exact_total",
    "iso_utc",
    "json_with",
    "money",
    "plain_number",
    "to_millis",
    "tumbling",
]
