import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import BASE, event, frame
from tidewatch.functions import contains_pattern, plain_number
from tidewatch.operators import enrich, reports, stats
from tidewatch.operators.alerts import alert_rows, as_alerts
from tidewatch.schemas import RISK_ALERTS, TRANSACTION_STATS


def test_window_edges_and_levels(spark):
    rows = [
        event(ms=0, seq=0, amount=1.1, category="a"),
        event(ms=4_999, seq=1, amount=2.2, category="ALL", result="failed"),
        event(ms=5_000, seq=2, amount=4.4, category="a"),
    ]
    found = stats.window_stats(frame(spark, rows)).collect()
    seen = {
        (r.window_start.timestamp() * 1000 - BASE, r.category, r.is_total): (r.total_amount, r.transaction_count)
        for r in found
    }
    assert seen == {
        (0, "a", False): (Decimal("1.10"), 1),
        (0, "ALL", False): (Decimal("2.20"), 1),
        (0, "ALL", True): (Decimal("3.30"), 2),
        (5_000, "a", False): (Decimal("4.40"), 1),
        (5_000, "ALL", True): (Decimal("4.40"), 1),
    }


def test_product_takes_first_category_that_is_not_empty(spark):
    rows = [event(ms=1, seq=2, category="late"), event(ms=0, seq=0, category=""), event(ms=1, seq=1, category="x")]
    rows += [event(ms=0, seq=5, category="", product="Q"), event(ms=0, seq=6, category=None, product="Q")]
    found = {r.product_name: r.category for r in stats.product_totals(frame(spark, rows)).collect()}
    assert found == {"P": "x", "Q": ""}


@pytest.mark.parametrize("slice_ms", [1, 7, 40, 60_000])
def test_running_totals(spark, slice_ms):
    random.seed(1)
    rows = [event(ms=random.randrange(40), seq=i, amount=random.randrange(10_000) / 100) for i in range(300)]
    total, expected = Decimal(0), {}
    for count, row in enumerate(sorted(rows, key=lambda r: (r[3], r[11])), start=1):
        total += Decimal(str(row[1]))
        expected[row[4]] = (total, count)
    found = stats.running_totals(frame(spark, rows), slice_ms).collect()
    assert {r.transaction_id: (r.total_amount, r.transaction_count) for r in found} == expected


def test_running_totals_of_copies(spark):
    rows = [event(ms=0, seq=0, txn="same", amount=2.0)] * 50
    found = stats.running_totals(frame(spark, rows), 6).collect()
    assert sorted(r.transaction_count for r in found) == list(range(1, 51))
    assert sorted(r.total_amount for r in found) == [2 * n for n in range(1, 51)]


def alert_table(spark, *rows):
    """Rows (type, user, transaction, amount, count, details, hours before noon of 2024-01-02)."""
    noon = datetime(2024, 1, 2, 12)
    full = [(t, u, x, a, c, None, None, d, noon - timedelta(hours=h)) for t, u, x, a, c, d, h in rows]
    return spark.createDataFrame(
        [(*r[:3], None if r[3] is None else Decimal(str(r[3])), *r[4:]) for r in full], RISK_ALERTS.schema
    )


@pytest.fixture(scope="module")
def alerts(spark):
    return alert_table(
        spark,
        ("LARGE_AMOUNT", "u1", "txn_a%", 6000, None, "Transaction", 0),
        ("LARGE_AMOUNT", "u1", "txn_b", 0, None, "Transaction", 1),
        ("HIGH_FREQUENCY", "u2", None, None, 5, "User U2 has 5", 23.5),
        ("FAILED_SURGE", "GLOBAL", None, None, 8, "8 failed", 24),
        ("FAILED_SURGE", "GLOBAL", None, None, 9, "9 failed", 24.5),
        ("FAILED_SURGE", "GLOBAL", None, None, 9, "9 failed", 30),
    )


def test_top_users_with_and_without_everybody(spark, alerts):
    users = spark.createDataFrame([("u1", "Ann"), ("u3", "Cid")], "user_id string, user_name string")
    known = reports.top_risky_users(alerts, users).collect()
    assert [tuple(r) for r in known] == [("u1", "Ann", 2)]
    everybody = reports.ranked(reports.top_risky_users_with_unknown(alerts, users, limit=3)).collect()
    assert sorted(map(tuple, everybody)) == [
        ("GLOBAL", "unknown", 3, "#1"), ("u1", "Ann", 2, "#2"), ("u2", "unknown", 1, "#3"),
    ]


def test_alert_search(alerts):
    def ids(**args):
        return [(r.user_id, r.transaction_id) for r in reports.alert_search(alerts, **args).collect()]

    assert ids(limit=2) == [("u1", "txn_a%"), ("u1", "txn_b")]
    assert ids(keyword="u2") == [("u2", None)]
    assert ids(keyword="u2 HAS", match_case=True) == []
    assert ids(keyword="txn%b") == [("u1", "txn_b")]  # a wildcard
    assert ids(keyword=r"a\%") == [("u1", "txn_a%")]  # an escaped one
    assert ids(keyword="txn", alert_type="FAILED_SURGE") == []
    assert [r.amount for r in reports.alert_search(alerts, keyword="txn", zero_as_null=True).collect()][1] is None
    assert [r.amount for r in reports.alert_search(alerts, keyword="txn").collect()][1] == 0


def test_backslash_in_keyword():
    assert contains_pattern("a\\b") == "%a\\\\b%"
    assert contains_pattern("a\\%\\") == "%a\\%\\\\%"


def test_counts_by_type_and_hour(alerts):
    assert [tuple(r) for r in reports.alerts_by_type(alerts).collect()] == [
        ("FAILED_SURGE", 3), ("LARGE_AMOUNT", 2), ("HIGH_FREQUENCY", 1),
    ]
    by_hour = reports.alerts_by_hour(alerts, datetime(2024, 1, 2, 12)).collect()
    # Exactly 24 hours before counts, and shares the label of noon today.
    assert [tuple(r) for r in by_hour] == [("11:00", 1), ("12:00", 3)]
    apart = reports.alerts_by_hour(alerts, datetime(2024, 1, 2, 12), full_hour=True).collect()
    assert [(r.hour, r.hour_start.day, r["count"]) for r in apart] == [("11:00", 2, 1), ("12:00", 1, 2), ("12:00", 2, 1)]
    assert reports.alerts_by_hour(alerts).count() == 0
    assert reports.alert_count(alerts).first()[0] == 6


def test_feed_values(spark):
    rows = spark.createDataFrame(
        [(6000.0, None, None), (None, 5, None), (None, 0, 3), (None, 0, 0)], "a double, n int, u int"
    )
    feed = reports.alert_feed(
        as_alerts(rows, "X", amount=F.col("a"), transaction_count=F.col("n"), user_count=F.col("u"))
    )
    assert sorted(r.value for r in feed.collect()) == ["-", "3", "5", "6000.00"]


def test_history_trend_and_latest(spark):
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(80):
        at = start + timedelta(seconds=5 * i)
        for category in ("ALL", "a", "b") if i < 70 else ("ALL", "a"):
            rows.append((at, at + timedelta(seconds=5), category, Decimal(i), i))
    table = spark.createDataFrame(rows, TRANSACTION_STATS.schema)
    assert reports.stats_history(table).count() == 200
    assert reports.stats_history(table, window_start=start).count() == 200  # one end alone does not count
    some = reports.stats_history(table, start + timedelta(seconds=5), start + timedelta(seconds=15)).collect()
    assert [r.transaction_count for r in some] == [2, 2, 2, 1, 1, 1]
    trend = [r.transaction_count for r in reports.recent_trend(table).collect()]
    assert trend == list(range(20, 80))
    latest = {r.category: r.transaction_count for r in reports.latest_by_category(table).collect()}
    assert latest == {"a": 79, "b": 69}


def test_alert_message_has_the_fields_of_its_type(spark):
    from tidewatch.operators.detectors import high_frequency, large_amount

    e = frame(spark, [event(ms=i + 500, seq=i, amount=6000) for i in range(5)])
    large = json.loads(enrich.alert_messages(large_amount(e)).first().value)
    assert set(large) == {"alert_type", "user_id", "transaction_id", "amount", "category", "alert_time", "details"}
    assert large["alert_time"] == "2023-11-14T22:00:00.500000+00:00"
    burst = json.loads(enrich.alert_messages(high_frequency(e)).first().value)
    assert set(burst) == {
        "alert_type", "user_id", "transaction_count", "window_start", "window_end", "alert_time", "details",
    }
    whole = frame(spark, [event(seq=1, amount=6000)])
    assert json.loads(enrich.alert_messages(large_amount(whole)).first().value)["alert_time"].endswith(":00+00:00")


def test_feed_of_topics(spark):
    messages = spark.createDataFrame([("a", '{"x": 1.0}'), ("b", "oops")], "topic string, value string")
    feed = sorted(r.value for r in enrich.tagged_messages(messages).collect())
    assert feed == ['{"topic":"a","data":{"x": 1.0}}', '{"topic":"b"}']


def test_plain_number(spark):
    values = [6000.0, 0.5, 123.45, 12345678.0, 12345678.25, 123456789012.5, -20000000.1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(plain_number("v")).collect()] == [repr(v) for v in values]


def test_alert_rows_match_the_table(spark):
    rows = alert_rows(as_alerts(spark.range(1), "X", user_id=F.lit("u"), user_count=F.lit(4)))
    assert rows.columns == RISK_ALERTS.schema.fieldNames()
    assert rows.first().transaction_count == 4
    with pytest.raises(ValueError):
        as_alerts(spark.range(1), "X", colour=F.lit("red"))
