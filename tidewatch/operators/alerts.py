"""The common alert shape: union of the detectors, table rows and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import ALERT_SCHEMA, RISK_ALERTS


def as_alerts(df: DataFrame, alert_type: str, **columns: Column) -> DataFrame:
    """Rows in the alert schema; fields the detector does not fill are null."""
    columns = {"alert_type": F.lit(alert_type), **columns}
    unknown = set(columns) - set(ALERT_SCHEMA.fieldNames())
    if unknown:
        raise ValueError(f"not alert fields: {sorted(unknown)}")
    return df.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ALERT_SCHEMA.fields
        ]
    )


def union_alerts(*alerts: DataFrame) -> DataFrame:
    """Bag union of the detectors' alerts, batch or stream."""
    return reduce(DataFrame.unionByName, alerts)


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Alerts as rows of the ``risk_alerts`` table, where a shared address keeps its user count as the count."""
    count = F.coalesce("transaction_count", "user_count")
    return alerts.withColumn("transaction_count", count).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RISK_ALERTS.schema.fields]
    )
