"""JSON transaction events to typed columns."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import LARGEST_AMOUNT
from tidewatch.schemas import EVENT_SCHEMA, FIELD_DEFAULTS, REQUIRED_FIELDS

# Milliseconds of the years 1 to 9999, the range a timestamp column can show.
_FIRST_MS, _LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def parse(raw: DataFrame, value: str = "value", seq: Column | None = None) -> DataFrame:
    """Event columns next to the raw text in ``value`` and the reason in ``error`` (null where the event is good).

    The text is read into a map of strings, because only a map tells an absent field, which gets its default,
    from an explicit null, which stays null. Quoted numbers are accepted and fractions of a millisecond cut.
    """
    fields = F.col("fields")
    text = {name: fields[name] for name in (*REQUIRED_FIELDS, *FIELD_DEFAULTS)}
    amount = text["amount"].try_cast("double")
    fraction = text["timestamp"].try_cast("decimal(38,6)").try_cast("bigint")  # slow, and hardly ever needed
    millis = F.coalesce(text["timestamp"].try_cast("bigint"), fraction)

    def or_default(name: str) -> Column:
        return F.when(F.map_contains_key(fields, name), text[name]).otherwise(F.lit(FIELD_DEFAULTS[name]))

    usable = F.abs(amount) < LARGEST_AMOUNT  # false for NaN too, which Spark sorts above infinity
    in_range = millis.between(_FIRST_MS, _LAST_MS)
    error = F.coalesce(
        F.when(fields.isNull(), F.lit("not a JSON object")),
        *[
            F.when(~F.map_contains_key(fields, name), F.lit(f"missing {name}"))
            for name in REQUIRED_FIELDS
        ],
        F.when(text["user_id"].isNull(), F.lit("null user_id")),
        F.when(F.abs(amount).between(LARGEST_AMOUNT, sys.float_info.max), F.lit("amount out of range")),
        F.when(~F.coalesce(usable, F.lit(False)), F.lit("bad amount")),
        F.when(~F.coalesce(in_range, F.lit(False)), F.lit("bad timestamp")),
    )
    columns = {
        "user_id": text["user_id"],
        "amount": F.when(usable, amount),
        "timestamp": F.when(in_range, millis),
        "transaction_id": text["transaction_id"],
        **{name: or_default(name) for name in FIELD_DEFAULTS},
        "event_time": F.timestamp_millis(F.when(in_range, millis)),
        "seq": F.lit(None).cast("bigint") if seq is None else seq.cast("bigint"),
    }
    # As a generator the parsing is done once per row; as a plain column the optimizer would repeat it in
    # every expression, filters included.
    read = F.explode(F.array(F.from_json(value, "map<string,string>")))
    return raw.withColumn("fields", read).select(
        *[columns[f.name].alias(f.name) for f in EVENT_SCHEMA.fields],
        F.col(value).alias("value"),
        error.alias("error"),
    )


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where("error IS NULL").select(*EVENT_SCHEMA.fieldNames())


def rejected_events(parsed: DataFrame) -> DataFrame:
    return parsed.where("error IS NOT NULL").select("value", "error")


def parse_events(
    raw: DataFrame, value: str = "value", seq: Column | None = None, on_error: str = "quarantine"
) -> DataFrame:
    """Good events only. Bad ones go to ``rejected_events`` of the same parse, or stop the job with ``fail``."""
    parsed = parse(raw, value, seq)
    if on_error == "quarantine":
        return good_events(parsed)
    if on_error == "fail":
        message = F.concat_ws(": ", "error", "value")
        checked = F.when(F.col("error").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
        return parsed.where(checked).select(*EVENT_SCHEMA.fieldNames())
    raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
