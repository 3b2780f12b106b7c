"""Running totals and tumbling-window statistics.

No statistic looks at the result or type of a transaction: failed and refunded ones count as well. Filter
the events first to have it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions import exact, exact_total, money, tumbling
from tidewatch.settings import DEFAULTS, RiskSettings

_WINDOW = ("window.start AS window_start", "window.end AS window_end")


def _totals() -> list[Column]:
    return [exact_total("amount").alias("total_amount"), F.count("*").alias("transaction_count")]


def window_totals(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Total and count per window, batch or stream. One busy window is one row per task after the partial
    aggregation."""
    return (
        events.groupBy(tumbling(settings.stats_window_seconds).alias("window"))
        .agg(*_totals())
        .selectExpr(*_WINDOW, "total_amount", "transaction_count")
    )


def category_totals(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Total and count per window and category, batch or stream."""
    return (
        events.groupBy(tumbling(settings.stats_window_seconds).alias("window"), "category")
        .agg(*_totals())
        .selectExpr(*_WINDOW, "category", "total_amount", "transaction_count")
    )


def window_stats(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Both levels in the shape of ``transaction_stats``: per category, and over all with the category
    ``ALL``. ``is_total`` tells the total from a category that is really called so (batch).

    Events are read and aggregated once; the totals are summed from the category rows.
    """
    keys = ["window_start", "window_end", "category"]
    by_category = (
        events.groupBy(tumbling(settings.stats_window_seconds).alias("window"), "category")
        .agg(F.sum(exact("amount")).alias("total"), F.count("*").alias("transaction_count"))
        .selectExpr(*_WINDOW, "category", "total", "transaction_count")
    )
    return (
        by_category.groupingSets([keys, keys[:2]], *keys)
        .agg(
            money(F.sum("total")).alias("total_amount"),
            F.sum("transaction_count").alias("transaction_count"),
            (F.grouping("category") == 1).alias("is_total"),
        )
        .withColumn("category", F.when(F.col("is_total"), S.ALL_CATEGORIES).otherwise(F.col("category")))
    )


def stats_rows(stats: DataFrame) -> DataFrame:
    """Statistics as rows of the ``transaction_stats`` table; plain window totals get the category ``ALL``."""
    if "category" not in stats.columns:
        stats = stats.withColumn("category", F.lit(S.ALL_CATEGORIES))
    return stats.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRANSACTION_STATS.schema.fields]
    )


def product_totals(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Total and count per window and product name, with the first category seen that is not empty: first to
    arrive by ``seq``, and without one first in time.

    Categories are added up on their own first. That step carries numbers only, which keeps it a hash
    aggregation; finding the first among the few categories of a product then has little to sort.
    """
    by_category = events.groupBy(
        tumbling(settings.stats_window_seconds).alias("window"), "product_name", "category"
    ).agg(
        F.sum(exact("amount")).alias("total"),
        F.count("*").alias("events"),
        F.min("seq").alias("arrival"),
        F.min("timestamp").alias("time"),
    )
    named = F.col("category") != ""
    first = F.min_by(
        F.when(named, F.col("category")), F.when(named, F.struct("arrival", "time", "category"))
    )
    return (
        by_category.groupBy("window", "product_name")
        .agg(
            F.coalesce(first, F.lit("")).alias("category"),
            money(F.sum("total")).alias("total_amount"),
            F.sum("events").alias("transaction_count"),
        )
        .selectExpr(*_WINDOW, "product_name", "category", "total_amount", "transaction_count")
    )


def overall_totals(events: DataFrame) -> DataFrame:
    """Total and count over everything. On a stream this is the running total, one row per trigger in
    complete mode."""
    return events.agg(*_totals())


def running_totals(events: DataFrame, slice_ms: int = 60_000) -> DataFrame:
    """Total and count after each event, in time order (batch).

    A window over all events would run in one task. Here the time line is cut into slices of a fixed width. Each
    keeps its own running sum and adds what the slices before it sum up to: one row per slice, which is all that is
    ever ordered in one task.
    """
    rows = events.select(
        *S.EVENT_ORDER,
        exact("amount").alias("exact"),
        F.floor(F.col("timestamp") / F.lit(slice_ms)).cast("bigint").alias("slice"),
    )
    earlier = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("slice")
        .agg(F.sum("exact").alias("total"), F.count("*").alias("events"))
        .select(
            "slice",
            F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("total_before"),
            F.coalesce(F.sum("events").over(earlier), F.lit(0)).alias("events_before"),
        )
    )
    so_far = W.partitionBy("slice").orderBy(*S.EVENT_ORDER, "exact").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        rows.withColumn("running_total", F.sum("exact").over(so_far))
        .withColumn("running_events", F.row_number().over(so_far))
        .join(offsets, "slice")
        .select(
            "transaction_id",
            "timestamp",
            money(F.col("total_before") + F.col("running_total")).alias("total_amount"),
            (F.col("events_before") + F.col("running_events")).cast("bigint").alias("transaction_count"),
        )
    )
