"""Registered stream queries: how often their input is put down, and in how many files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import queries
from tidewatch.sources.files import arrival_files


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three users with an event every ten minutes, of two types and one address."""
    at = dt.datetime(2024, 1, 1)
    rows = [
        (n, at + dt.timedelta(minutes=10 * n), n % 3, ("click", "error")[n % 2], float(n), '{"k": 7}') for n in range(300)
    ]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/events.parquet")
    return path


@pytest.fixture
def written(monkeypatch):
    calls = []

    def write(rows, arrival, path, numbers, files=4):
        calls.extend((n, files) for n in numbers)
        plain(rows, arrival, path, numbers, files)

    plain = queries.write_arrivals
    monkeypatch.setattr(queries, "write_arrivals", write)
    return calls


def test_files_of_an_arrival_follow_the_rows():
    assert [arrival_files(n, 3) for n in (0, 300, 1_200_000, 1_200_001, 36_000_000)] == [4, 4, 4, 5, 120]


@pytest.mark.parametrize("name", ["stream_stats_history", "stream_ip_sharing_members"])
def test_two_streams_share_one_input(spark, folder, written, name):
    queries.REGISTRY[name].run(spark, folder).count()
    assert written == [(0, 4), (1, 4), (2, 4)]


def test_streams_side_by_side_give_what_each_gives(spark, folder):
    users, alerts = queries.replays(spark, folder, ("ip_sharing_users", "ip_sharing"), queries.SAMPLE)
    assert users.count() == 150  # 50 hours of six events, each of three users twice
    counts = alerts.select("user_count", "ip_address").distinct().collect()
    assert [tuple(c) for c in counts] == [(3, "10.0.0.8")] and alerts.count() == 49  # the last hour is open
    assert alerts.where(F.col("batch_id").isNull()).count() == 0


def test_larger_input_goes_to_more_files(spark, folder, written, monkeypatch):
    monkeypatch.setattr("tidewatch.sources.files.FILE_ROWS", 10)
    totals = queries.REGISTRY["stream_running_totals"].run(spark, folder).first()
    assert {files for _, files in written} == {10} and totals.transaction_count == 300


def test_state_rows_are_not_counted(spark, folder):
    """Which would be a lookup more for every row written."""
    queries.REGISTRY["stream_running_totals"].run(spark, folder)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
