"""Small in-code events and row-at-a-time models of the rules."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from tidewatch.schemas import EVENT_SCHEMA

BASE = 1_700_000_000_000 - 1_700_000_000_000 % 3_600_000  # a full hour


def event(user="u", ms=0, seq=0, amount=1.0, result="success", ip="1.1.1.1", category="c", product="P", txn=None):
    return (user, float(amount), category, BASE + ms, txn or f"t{seq}", result, "purchase", ip, "p", product, None, seq)


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA).withColumn("event_time", F.timestamp_millis("timestamp"))


def burst_model(rows, window=300_000, least=5):
    """Events one by one; returns (user, time, count) of the alerts."""
    kept = defaultdict(list)
    found = []
    for row in rows:
        user, at = row[0], row[3]
        kept[user] = [t for t in kept[user] if t > at - window] + [at]
        if len(kept[user]) >= least:
            found.append((user, at, len(kept[user])))
    return sorted(found)


def growth_model(rows, length=3, factor=1.1):
    """Events one by one; returns (transaction, amounts) of the alerts."""
    runs = defaultdict(list)
    found = []
    for row in rows:
        run = runs[row[0]]
        if run and row[1] < run[-1] * factor:
            run.clear()
        run.append(row[1])
        if len(run) == length:
            found.append((row[4], tuple(run)))
            run.clear()
    return sorted(found)
