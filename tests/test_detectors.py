import random

import pytest
from pyspark.sql import functions as F

from tests.rows import BASE, burst_model, event, frame, growth_model
from tidewatch.operators import detectors as D
from tidewatch.operators import stats
from tidewatch.operators.alerts import alert_rows
from tidewatch.plans.batch import all_alerts
from tidewatch.settings import RiskSettings


def bursts(df, settings=RiskSettings()):
    found = D.high_frequency(df, settings).select(
        "user_id", F.unix_millis("window_end"), "transaction_count"
    )
    return sorted(map(tuple, found.collect()))


def growths(df, settings=RiskSettings(), slice_ms=3_600_000):
    found = D.continuous_increase(df, settings, slice_ms).select("transaction_id", "amounts").collect()
    return sorted((r[0], tuple(r[1])) for r in found)


def test_large_amount_is_strict(spark):
    rows = [event(seq=1, amount=5000), event(seq=2, amount=5000.01), event(seq=3, amount=12345678.9)]
    found = D.large_amount(frame(spark, rows)).orderBy("transaction_id").collect()
    assert [r.details for r in found] == [
        "Transaction t2 amount 5000.01 exceeds 5000.0",
        "Transaction t3 amount 12345678.9 exceeds 5000.0",
    ]
    assert found[0].alert_time.timestamp() * 1000 == BASE and found[0].category == "c"


@pytest.mark.parametrize("times, alerts", [((0, 1, 2, 3), 0), ((0, 1, 2, 3, 4), 1), ((0, 1, 2, 3, 300_000), 0),
                                           ((0, 1, 2, 3, 299_999), 1), ((7, 7, 7, 7, 7, 7), 2)])
def test_burst_boundaries(spark, times, alerts):
    rows = [event(ms=t, seq=i) for i, t in enumerate(times)]
    found = bursts(frame(spark, rows))
    assert len(found) == alerts
    assert found == burst_model(rows)


def test_burst_alert_fields(spark):
    rows = [event(ms=i, seq=i) for i in range(5)]
    alert = D.high_frequency(frame(spark, rows)).first()
    assert alert.details == "User u has 5 transactions in last 300 seconds"
    assert (alert.window_end - alert.window_start).total_seconds() == 300
    assert alert.transaction_id is None and alert.alert_time == alert.window_end


@pytest.mark.parametrize("seed", range(4))
def test_bursts_equal_model(spark, seed):
    random.seed(seed)
    span = random.choice([2_000, 40_000, 400_000])
    # Many equal times, negative and positive slices of the time line, users of very different size.
    rows = [
        event(user=random.choice("aaaaab"), ms=random.randrange(-span, span) // 50 * 50, seq=i) for i in range(600)
    ]
    rows.sort(key=lambda r: (r[3], r[11]))
    window, least = random.choice([(100, 2), (1_000, 3), (7_777, 5)])
    settings = RiskSettings(burst_window_ms=window, burst_count=least)
    assert bursts(frame(spark, rows), settings) == burst_model(rows, window, least)


def test_many_events_of_one_millisecond(spark, monkeypatch):
    monkeypatch.setattr(D, "_TIE_BLOCK", 7)
    rows = [event(ms=0, seq=i) for i in range(40)]
    assert bursts(frame(spark, rows)) == burst_model(rows)


@pytest.mark.parametrize("amounts, alerts", [((1, 2), 0), ((1, 2, 4), 1), ((1, 2, 4, 8, 16), 1),
                                             ((1, 2, 4, 8, 16, 32), 2), ((100, 110.00000000000001, 122), 1),
                                             ((100, 109.99, 122), 0), ((0, 0, 0), 1), ((3, 3.2, 3.6), 0)])
@pytest.mark.parametrize("slice_ms", [3_600_000, 2])
def test_growth_boundaries(spark, amounts, alerts, slice_ms):
    rows = [event(ms=i, seq=i, amount=a) for i, a in enumerate(amounts)]
    found = growths(frame(spark, rows), slice_ms=slice_ms)
    assert len(found) == alerts
    assert found == growth_model(rows)


@pytest.mark.parametrize("slice_ms", [1, 7, 40, 3_600_000])
def test_growth_equals_model_across_slices(spark, slice_ms):
    random.seed(slice_ms)
    rows, level = [], 1.0
    for i in range(800):
        # Long runs, so that many of them cross slices, some over several slices in one go.
        level = level * random.choice([1.1, 1.2, 1.5]) if random.random() < 0.93 and level < 1e12 else 1.0
        rows.append(event(user=random.choice("aaaab"), ms=i // 3, seq=i, amount=round(level, 2)))
    assert growths(frame(spark, rows), slice_ms=slice_ms) == growth_model(rows)


def test_growth_of_other_lengths(spark):
    random.seed(9)
    rows = [event(ms=i, seq=i, amount=random.choice([1, 2, 4, 8, 16, 32])) for i in range(400)]
    for length in (2, 4):
        settings = RiskSettings(growth_length=length, growth_factor=2.0)
        assert growths(frame(spark, rows), settings, 9) == growth_model(rows, length, 2.0)


@pytest.mark.parametrize("failed, alerts", [(7, 0), (8, 1)])
def test_failed_surge_boundary(spark, failed, alerts):
    rows = [event(ms=i, seq=i, result="failed") for i in range(failed)]
    rows += [event(ms=5, seq=100), event(ms=30_000, seq=101, result="failed")]  # fine, and in the next window
    found = D.failed_surge(frame(spark, rows)).collect()
    assert len(found) == alerts
    if found:
        assert found[0].details == "8 failed transactions in last 30s"
        assert (found[0].user_id, found[0].transaction_count) == ("GLOBAL", 8)


def test_shared_address(spark):
    rows = [event(user=u, ms=i, seq=i) for i, u in enumerate(["b", "a", "b", "c"])]
    rows += [event(user=u, ms=i, seq=10 + i, ip="2.2.2.2") for i, u in enumerate("xy")]
    rows += [event(user="z", ms=60_000, seq=20, ip="2.2.2.2")]  # on the edge: the next window
    found = D.ip_sharing(frame(spark, rows)).collect()
    assert len(found) == 1
    assert found[0].details == "IP 1.1.1.1 has 3 distinct users in 60s"
    assert (found[0].user_id, found[0].user_count) == ("a", 3)
    assert alert_rows(D.ip_sharing(frame(spark, rows))).first().transaction_count == 3


@pytest.mark.parametrize("users", [1_000, 1_001, 100_000])
def test_busy_address_has_one_shape(spark, users):
    name = F.format_string("u%06d", "id")
    first = frame(spark, [event()])
    rows = spark.range(users).crossJoin(first.drop("user_id", "seq")).withColumns({"user_id": name, "seq": F.col("id")})
    rows = rows.select(*first.columns)
    alert = D.ip_sharing(rows).first()
    assert (alert.user_count, alert.user_id) == (users, "u000000")
    assert alert.details == f"IP 1.1.1.1 has {users} distinct users in 60s"
    members = D.ip_sharing_members(rows)
    assert members.count() == members.select("user_id").distinct().count() == users


def test_large_and_small_amounts_reach_their_tables(spark):
    large = frame(spark, [event(seq=1, amount=2e10), event(seq=2, amount=5e13)])
    amounts = [float(r.amount) for r in alert_rows(D.large_amount(large)).orderBy("amount").collect()]
    assert amounts == [2e10, 5e13]
    busy = frame(spark, [event(seq=i, ms=i, amount=9e9) for i in range(200)])
    row = stats.stats_rows(stats.window_totals(busy)).first()
    assert (float(row.total_amount), row.transaction_count) == (1.8e12, 200)
    tiny = frame(spark, [event(seq=i, ms=i, amount=0.004) for i in range(1000)])
    assert float(stats.overall_totals(tiny).first().total_amount) == 4.0
    assert {float(r.total_amount) for r in stats.window_stats(tiny).collect()} == {4.0}


def test_placeholder_address_can_be_left_out(spark):
    rows = [event(user=u, seq=i, ip="0.0.0.0") for i, u in enumerate("abc")]
    assert D.ip_sharing(frame(spark, rows)).count() == 1
    assert D.ip_sharing(frame(spark, rows), RiskSettings(excluded_ips=("0.0.0.0",))).count() == 0


def test_all_alerts_unites_the_five(spark):
    rows = [event(user="a", ms=i, seq=i, amount=6000 * 1.2**i, result="failed") for i in range(9)]
    rows += [event(user=u, ms=9, seq=20 + i) for i, u in enumerate("bc")]
    types = {r.alert_type: r["count"] for r in all_alerts(frame(spark, rows)).groupBy("alert_type").count().collect()}
    assert types == {
        "LARGE_AMOUNT": 9, "HIGH_FREQUENCY": 5, "CONTINUOUS_INCREASE": 3, "FAILED_SURGE": 1, "IP_SHARING": 1,
    }


def test_settings_are_checked():
    with pytest.raises(ValueError):
        RiskSettings(growth_length=1)
    with pytest.raises(ValueError):
        RiskSettings(burst_count=0)
