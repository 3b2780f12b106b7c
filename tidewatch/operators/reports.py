"""Report queries over the result tables.

``alerts`` are rows of ``risk_alerts``, ``stats`` rows of ``transaction_stats``. Orderings end in enough
columns to be stable. Limits are part of the reports: each becomes a top-k per task and a merge of those.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions import contains_pattern
from tidewatch.schemas import ALL_CATEGORIES



def _newest_alerts() -> list[Column | str]:
    ties = ["alert_type", "user_id", "transaction_id", "transaction_count", "details"]
    return [F.col("alert_time").desc(), *ties]


def category_list(categories: DataFrame) -> DataFrame:
    return categories.select("category", "description")


def stats_history(
    stats: DataFrame,
    window_start: datetime | str | None = None,
    window_end: datetime | str | None = None,
    limit: int = 200,
) -> DataFrame:
    """Newest windows first. The range counts only if both ends are given."""
    if window_start and window_end:
        stats = stats.where(
            (F.col("window_start") >= F.lit(window_start).cast("timestamp"))
            & (F.col("window_end") <= F.lit(window_end).cast("timestamp"))
        )
    return (
        stats.select("window_start", "window_end", "category", "total_amount", "transaction_count")
        .orderBy(F.col("window_start").desc(), "window_end", "category", "total_amount", "transaction_count")
        .limit(limit)
    )


def alert_search(
    alerts: DataFrame,
    alert_type: str | None = None,
    keyword: str | None = None,
    limit: int = 500,
    match_case: bool = False,
    zero_as_null: bool = False,
) -> DataFrame:
    """Newest alerts first, by type and by a keyword in user, transaction or details."""
    if alert_type:
        alerts = alerts.where(F.col("alert_type") == alert_type)
    if keyword:
        pattern = contains_pattern(keyword)
        columns = [F.col(c) for c in ("user_id", "transaction_id", "details")]
        hits = [c.like(pattern) if match_case else c.ilike(pattern) for c in columns]
        alerts = alerts.where(hits[0] | hits[1] | hits[2])
    amount = F.nullif(F.col("amount"), F.lit(0).cast("decimal(28,2)")) if zero_as_null else F.col("amount")
    return (
        alerts.select(
            "alert_type",
            "user_id",
            "transaction_id",
            amount.alias("amount"),
            "transaction_count",
            "details",
            "alert_time",
        )
        .orderBy(*_newest_alerts())
        .limit(limit)
    )


def alerts_per_user(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("user_id").agg(F.count("*").alias("alert_count"))


def _most_alerts(counts: DataFrame, limit: int) -> DataFrame:
    return counts.orderBy(F.col("alert_count").desc(), "user_id").limit(limit)


def top_risky_users(alerts: DataFrame, users: DataFrame, limit: int = 5) -> DataFrame:
    """Known users with most alerts. Alerts of everybody at once have no user row and fall out.

    Alerts are counted before the join, so a user with very many of them is one row by then; the users table
    has one row per user, which makes the result that of a join first.
    """
    named = alerts_per_user(alerts).join(users.select("user_id", "user_name"), "user_id")
    return _most_alerts(named.select("user_id", "user_name", "alert_count"), limit)


def top_risky_users_with_unknown(alerts: DataFrame, users: DataFrame, limit: int = 5) -> DataFrame:
    """Users with most alerts, then their names; those without a user row are called ``unknown``."""
    top = _most_alerts(alerts_per_user(alerts), limit)
    # At most ``limit`` ids: the users table is filtered by them where it is read, and never shuffled.
    names = users.select("user_id", "user_name").join(
        F.broadcast(top.select("user_id")), "user_id", "left_semi"
    )
    return _most_alerts(
        top.join(F.broadcast(names), "user_id", "left").select(
            "user_id", F.coalesce("user_name", F.lit("unknown")).alias("user_name"), "alert_count"
        ),
        limit,
    )


def ranked(top_users: DataFrame) -> DataFrame:
    """Numbers ``#1``, ``#2``, ... for an already limited list of users."""
    by_count = W.orderBy(F.col("alert_count").desc(), "user_id")
    return top_users.withColumn("rank", F.concat(F.lit("#"), F.row_number().over(by_count)))


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("alert_type")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "alert_type")
    )


def alerts_by_hour(
    alerts: DataFrame, as_of: datetime | Column | None = None, full_hour: bool = False
) -> DataFrame:
    """Alerts of the 24 hours up to ``as_of`` (now by default) by hour of day, ``00:00`` to ``23:00``.

    The label of the present hour also counts what is left of the same hour yesterday; ``full_hour`` tells
    them apart by a column ``hour_start``.
    """
    if as_of is None:
        now = F.current_timestamp()
    else:
        now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    keys = [F.date_format("alert_time", "HH:00").alias("hour")]
    if full_hour:
        keys.append(F.date_trunc("hour", "alert_time").alias("hour_start"))
    return (
        alerts.where(F.col("alert_time") >= now - F.expr("INTERVAL 24 HOURS"))
        .groupBy(*keys)
        .agg(F.count("*").alias("count"))
        .orderBy("hour", *(["hour_start"] if full_hour else []))
    )


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("alert_count"))


def alert_feed(alerts: DataFrame, limit: int = 200) -> DataFrame:
    """The newest alerts with the one value to show: amount, else a count other than zero, else ``-``.

    Takes the full alerts (``user_count`` is not a table column).
    """
    newest = alerts.orderBy(*_newest_alerts()).limit(limit)
    shown = F.coalesce(
        F.col("amount").cast("decimal(18,2)").cast("string"),
        F.nullif(F.col("transaction_count"), F.lit(0)).cast("string"),
        F.nullif(F.col("user_count"), F.lit(0)).cast("string"),
        F.lit("-"),
    )
    return newest.select(
        "alert_time",
        "alert_type",
        "user_id",
        F.coalesce(F.nullif("transaction_id", F.lit("")), F.lit("-")).alias("transaction_id"),
        shown.alias("value"),
        F.coalesce("details", F.lit("")).alias("details"),
    )


def recent_trend(stats: DataFrame, windows: int = 60) -> DataFrame:
    """The last windows over all categories, oldest first."""
    return (
        stats.where(F.col("category") == ALL_CATEGORIES)
        .select("window_start", "total_amount", "transaction_count")
        .orderBy(F.col("window_start").desc())
        .limit(windows)
        .orderBy("window_start")
    )


def latest_by_category(stats: DataFrame) -> DataFrame:
    """Total and count of each category's newest window."""
    return (
        stats.where(F.col("category") != ALL_CATEGORIES)
        .groupBy("category")
        .agg(
            F.max("window_start").alias("window_start"),
            F.max_by("total_amount", "window_start").alias("total_amount"),
            F.max_by("transaction_count", "window_start").alias("transaction_count"),
        )
    )
