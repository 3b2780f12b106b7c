"""Whole batch jobs put together from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.operators import detectors as D
from tidewatch.operators.alerts import alert_rows, union_alerts
from tidewatch.operators.stats import stats_rows, window_stats
from tidewatch.settings import DEFAULTS, RiskSettings


def all_alerts(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Alerts of the five detectors. Each reads only the columns it needs."""
    return union_alerts(
        D.large_amount(events, settings),
        D.high_frequency(events, settings),
        D.continuous_increase(events, settings),
        D.failed_surge(events, settings),
        D.ip_sharing(events, settings),
    )


def rebuild_results(
    events: DataFrame, alerts_path: str, stats_path: str, settings: RiskSettings = DEFAULTS
) -> None:
    """Write both result tables anew from stored events. Alerts are laid out by type, statistics by day, so
    that reports read only the folders they ask for. Rebalancing before the write gives each folder files of
    a sensible size, several where a type or day is full, instead of one from every task."""
    rows = alert_rows(all_alerts(events, settings)).hint("rebalance", "alert_type")
    rows.write.mode("overwrite").partitionBy("alert_type").parquet(alerts_path)
    stats = stats_rows(window_stats(events, settings)).selectExpr("*", "to_date(window_start) AS day")
    stats.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(stats_path)
