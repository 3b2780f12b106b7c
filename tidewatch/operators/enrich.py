"""Facts to event messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import iso_utc, json_with, to_millis
from tidewatch.schemas import FIELD_DEFAULTS


def enrich_transactions(facts: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Add the user's address and the product's name, with the defaults where there is no such row.

    ``facts`` may be a stream; the dimensions have unique keys. Whether a dimension is broadcast is left to
    its measured size; beyond that the join shuffles, and adaptive execution splits keys that are too full.
    """
    addresses = users.select("user_id", "ip_address", F.lit(True).alias("known_user"))
    names = products.select("product_id", "product_name", F.lit(True).alias("known_product"))
    # A row with a null address keeps the null; only a user without a row gets the placeholder.
    return (
        facts.join(addresses, "user_id", "left")
        .join(names, "product_id", "left")
        .withColumn(
            "ip_address",
            F.when(F.col("known_user"), F.col("ip_address")).otherwise(F.lit(FIELD_DEFAULTS["ip_address"])),
        )
        .withColumn(
            "product_name",
            F.when(F.col("known_product"), F.col("product_name")).otherwise(
                F.lit(FIELD_DEFAULTS["product_name"])
            ),
        )
        .drop("known_user", "known_product")
    )


def event_messages(enriched: DataFrame) -> DataFrame:
    """One JSON event per fact, as ``parse`` reads it. ``event_time`` may be a timestamp or its text."""
    is_text = dict(enriched.dtypes)["event_time"] == "string"
    millis = to_millis("event_time") if is_text else F.unix_millis("event_time")
    return enriched.select(
        F.to_json(
            F.struct(
                "transaction_id",
                "user_id",
                "product_id",
                "category",
                F.col("amount").cast("double").alias("amount"),
                "transaction_type",
                "result",
                "ip_address",
                "product_name",
                millis.alias("timestamp"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )


def event_time_text(time: str = "event_time"):
    """Millisecond text form of a timestamp, as facts are loaded with."""
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSS")


def alert_messages(alerts: DataFrame) -> DataFrame:
    """One JSON object per alert with the fields its type has."""
    times = {c: iso_utc(c) for c in ("window_start", "window_end", "alert_time")}
    return alerts.withColumns(times).select(F.to_json(F.struct("*")).alias("value"))


def stats_messages(totals: DataFrame) -> DataFrame:
    """One JSON object per window, its bounds in epoch milliseconds."""
    bounds = {c: F.unix_millis(c) for c in ("window_start", "window_end")}
    plain = totals.withColumns(bounds).withColumn("total_amount", F.col("total_amount").cast("double"))
    return plain.select(F.to_json(F.struct("*")).alias("value"))


def running_messages(totals: DataFrame, update_time=None) -> DataFrame:
    """The running total as JSON, stamped with the time it was made (now by default)."""
    stamp = iso_utc(F.current_timestamp() if update_time is None else update_time)
    return totals.select(
        F.to_json(
            F.struct(
                F.col("total_amount").cast("double").alias("total_amount"),
                "transaction_count",
                stamp.alias("update_time"),
            )
        ).alias("value")
    )


def snapshot_messages(users: DataFrame) -> DataFrame:
    """Every row of the users dimension as a keyed JSON message."""
    fields = ("user_id", "user_name", "ip_address", "account_type", "device")
    return users.select(
        F.col("user_id").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def tagged_messages(messages: DataFrame) -> DataFrame:
    """Messages (topic, value) of several topics as one feed of ``{"topic": ..., "data": ...}``. The text of
    the data is kept as it is; text that is not JSON gets no data."""
    topic = F.to_json(F.struct("topic"))
    is_json = F.try_parse_json("value").isNotNull()
    data = F.concat(F.lit('"data":'), "value")
    return messages.select("topic", F.when(is_json, json_with(topic, data)).otherwise(topic).alias("value"))
