"""One key with a third of all rows must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from tests.rows import BASE
from tidewatch.operators import detectors, stats
from tidewatch.schemas import EVENT_SCHEMA
from tidewatch.settings import RiskSettings

ROWS = 60_000


@pytest.fixture(scope="module")
def events(spark):
    """A third of the rows belongs to one user and one address; the rest to a thousand of each."""
    n = F.col("id")
    hot = n % 3 == 0
    other = F.concat(F.lit("u"), (n % 1000).cast("string"))
    columns = {
        "user_id": F.when(hot, "hot").otherwise(other),
        "amount": (F.pmod(F.xxhash64(n), F.lit(50_000)) / 100).cast("double"),
        "category": F.lit("c"),
        "timestamp": F.lit(BASE) + n * 20,
        "transaction_id": F.concat(F.lit("t"), n.cast("string")),
        "result": F.lit("failed"),
        "transaction_type": F.lit("purchase"),
        "ip_address": F.when(hot, "0.0.0.0").otherwise(other),
        "product_id": F.lit("p"),
        "product_name": F.lit("P"),
        "event_time": F.timestamp_millis(F.lit(BASE) + n * 20),
        "seq": n,
    }
    return spark.range(0, ROWS, 1, 8).select(*[columns[c].alias(c) for c in EVENT_SCHEMA.fieldNames()])


def test_results_do_not_depend_on_the_slices(events):
    alerts = [
        detectors.continuous_increase(events, slice_ms=ms).groupBy("user_id").count().orderBy("user_id").collect()
        for ms in (10_000, 10_000_000)
    ]
    assert alerts[0] == alerts[1] and alerts[0][0].user_id == "hot"
    totals = [
        stats.running_totals(events, ms).agg(F.sum("total_amount"), F.max("transaction_count")).first()
        for ms in (10_000, 10_000_000)
    ]
    assert totals[0] == totals[1] and totals[0][1] == ROWS


def test_growing_runs_of_a_user_within_an_hour_lie_in_bounded_slices(events):
    # 20,000 events of one user in twenty minutes: 1,000 a minute, 17 a second.
    hot = events.where("user_id = 'hot'")
    for most, largest in ((100_000, 20_000), (1_000, 1_000), (500, 17)):
        sizes = detectors._sliced(hot, 3_600_000, most).groupBy("user_id", "slice").count()
        assert sizes.agg(F.max("count")).first()[0] == largest
    found = [
        sorted(map(str, detectors.continuous_increase(hot, slice_rows=most).collect())) for most in (100_000, 1_000, 500)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) > 100


def test_bursts_carry_over_many_slices(events):
    # The window is longer than the data, so every event counts all before it, over two slices.
    settings = RiskSettings(burst_window_ms=86_400_000)
    found = detectors.high_frequency(events.where("user_id = 'hot'"), settings)
    seen = found.agg(F.count("*"), F.min("transaction_count"), F.max("transaction_count"), F.sum("transaction_count")).first()
    n, least = ROWS // 3, settings.burst_count
    assert tuple(seen) == (n - least + 1, least, n, (least + n) * (n - least + 1) // 2)


def test_building_runs_no_job_and_leaves_nothing(spark, events, tmp_path):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    detectors.continuous_increase(events), stats.running_totals(events), detectors.high_frequency(events)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_hot_address_is_counted_in_parts(events):
    settings = RiskSettings(shared_ip_window_seconds=3600)
    whole = events.withColumn("ip_address", F.lit("0.0.0.0"))
    found = detectors.ip_sharing(whole, settings)
    assert "collect_" not in found._jdf.queryExecution().toString()
    assert found.first().user_count == 1001
    assert detectors.ip_sharing_members(whole, settings).count() == 1001


def test_bursts_of_a_hot_user_lie_in_slices(events):
    # 20,000 events of one user, one every 60 ms, so 5,000 of them in five minutes.
    found = detectors.high_frequency(events.where("user_id = 'hot'"))
    assert found.count() == ROWS // 3 - 4
    assert found.agg(F.max("transaction_count")).first()[0] == 5_000
    plan = found._jdf.queryExecution().toString()
    assert "hashpartitioning(user_id" in plan and "slice" in plan
