"""Streams against their batch forms: several files per run, restarts, late and out-of-order events."""

import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import detectors, stats
from tidewatch.schemas import EVENT_SCHEMA
from tidewatch.settings import RiskSettings
from tidewatch.sinks.tables import append_alerts, read_alerts, read_stats, upsert_stats, write_batches
from tidewatch.sources import star
from tidewatch.sources.files import replay_table
from tidewatch.streaming.jobs import RESULTS, start, start_results, watermarked
from tidewatch.streaming.stateful import stream_high_frequency

SETTINGS = RiskSettings(
    large_amount=100.0,
    burst_window_ms=86_400_000,
    failed_window_seconds=3600,
    failed_count=2,
    shared_ip_window_seconds=6 * 3600,
    shared_ip_users=2,
    stats_window_seconds=3600,
)
ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def replayed(spark, tmp_path_factory):
    """The sample events as four files in time order, and all results of a replay, one file per trigger."""
    root = tmp_path_factory.mktemp("replay")
    events = star.events(spark, "/root/testdata/sf0.001").cache()
    slices = events.withColumn("part", F.ntile(4).over(_by_time()))
    for part in range(1, 5):
        rows = slices.where(F.col("part") == part).drop("part").coalesce(1)
        rows.write.parquet(f"{root}/in/{part}")
    stream = (
        spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    )
    queries = start_results(stream, f"{root}/out", settings=SETTINGS, trigger=ONCE, files_per_trigger=1)
    for query in queries.values():
        query.awaitTermination()
    return events, f"{root}/out", queries


def _by_time():
    from pyspark.sql import Window

    return Window.orderBy("timestamp")


def rows_of(df):
    return sorted(map(str, df.collect()))


def closed(df, events):
    newest = events.agg(F.max("event_time")).first()[0]
    return df.where(F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 2 SECONDS"))


@pytest.mark.parametrize("name", ["large_amount", "high_frequency", "continuous_increase"])
def test_event_alerts_equal_batch(spark, replayed, name):
    from tidewatch.operators.alerts import alert_rows

    events, out, _ = replayed
    expected = rows_of(alert_rows(getattr(detectors, name)(events, SETTINGS)))
    assert expected
    assert rows_of(read_alerts(spark, f"{out}/alerts/detector={name}")) == expected


@pytest.mark.parametrize("name", ["failed_surge", "ip_sharing"])
def test_window_alerts_equal_batch(spark, replayed, name):
    from tidewatch.operators.alerts import alert_rows

    events, out, _ = replayed
    expected = rows_of(closed(alert_rows(getattr(detectors, name)(events, SETTINGS)), events))
    assert expected
    assert rows_of(read_alerts(spark, f"{out}/alerts/detector={name}")) == expected


def test_stats_equal_batch(spark, replayed):
    events, out, _ = replayed
    expected = rows_of(closed(stats.stats_rows(stats.window_stats(events, SETTINGS)), events))
    assert expected
    assert rows_of(read_stats(spark, f"{out}/stats")) == expected


def test_messages_reach_their_topics(spark, replayed):
    events, out, queries = replayed
    count = spark.read.text(f"{out}/topics/product_aggregated_events/*").count()
    assert count == closed(stats.product_totals(events, SETTINGS), events).count()
    last = spark.read.text(f"{out}/topics/total_amount_and_count_events/*/batch_id=3").first()[0]
    total = stats.overall_totals(events).first()
    assert f'"total_amount":{float(total[0])},"transaction_count":{total[1]},' in last
    assert queries.keys() == RESULTS.keys() | {"feed"}


def event(user, ms, seq, amount=1.0, ip="1.1.1.1"):
    return (user, float(amount), "c", ms, f"t{seq}", "success", "purchase", ip, "p", "P", None, seq)


def frame(spark, rows):
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    return df.withColumn("event_time", F.timestamp_millis("timestamp"))


def arrival_model(rows, window, least):
    """Row at a time, in order of arrival, as the rule is told."""
    kept = defaultdict(list)
    found = []
    for row in rows:
        user, at = row[0], row[3]
        kept[user] = [t for t in kept[user] if t > at - window] + [at]
        if len(kept[user]) >= least:
            found.append((user, at, len(kept[user])))
    return sorted(found)


def run_files(spark, tmp_path, batches, build, write, tag="q"):
    """One trigger per batch of rows; returns after the last."""
    for number, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in/{number:03d}")
        stream = spark.readStream.schema(EVENT_SCHEMA).parquet(f"{tmp_path}/in/*")
        start(build(watermarked(stream)), write, f"{tmp_path}/{tag}", trigger=ONCE).awaitTermination()


def test_out_of_order_bursts_follow_arrival(spark, tmp_path):
    random.seed(3)
    start_ms = 1_700_000_000_000
    rows = []
    for seq in range(240):
        late = random.choice([0, 0, 0, 900, 1900])  # within the two seconds of the watermark
        rows.append(event(f"u{random.randint(0, 2)}", start_ms + seq * 400 - late, seq))
    settings = RiskSettings(burst_window_ms=5000, burst_count=3, burst_idle_ms=0)
    out = f"{tmp_path}/out"
    batches = [rows[:80], rows[80:160], rows[160:]]
    run_files(
        spark, tmp_path, batches, lambda e: stream_high_frequency(e, settings), write_batches(out, "a")
    )
    got = spark.read.parquet(out).select("user_id", F.unix_millis("window_end"), "transaction_count")
    assert sorted(map(tuple, got.collect())) == arrival_model(rows, 5000, 3)


def test_late_rows_leave_closed_windows_alone(spark, tmp_path):
    base = 1_700_000_000_000
    on_time = [event("u", base + 1000, 0, 5), event("u", base + 60_000, 1, 5)]
    late = [event("u", base + 2000, 2, 7), event("u", base + 61_000, 3, 5)]
    out = f"{tmp_path}/out"
    run_files(
        spark, tmp_path, [on_time, late, [event("u", base + 120_000, 4)]],
        lambda e: stats.window_totals(e), upsert_stats(out, "a"),
    )
    first = read_stats(spark, out).orderBy("window_start").first()
    assert (float(first.total_amount), first.transaction_count) == (5.0, 1)


def test_late_rows_count_for_bursts(spark, tmp_path):
    base = 1_700_000_000_000
    batches = [
        [event("u", base, 0), event("u", base + 1000, 1)],
        [event("u", base + 100_000, 2)],
        [event("u", base + 99_000, 3), event("u", base + 97_999, 4)],
    ]
    settings = RiskSettings(burst_window_ms=5000, burst_count=2, burst_idle_ms=0)
    out = f"{tmp_path}/out"
    run_files(
        spark, tmp_path, batches,
        lambda e: stream_high_frequency(e, settings), write_batches(out, "a"),
    )
    got = spark.read.parquet(out).select("user_id", F.unix_millis("window_end"), "transaction_count")
    flat = [row for batch in batches for row in batch]
    assert sorted(map(tuple, got.collect())) == arrival_model(flat, 5000, 2)


def test_repeated_batches_leave_no_row_twice(spark, tmp_path):
    rows = frame(spark, [event("u", 1_700_000_000_000 + i, i, 9000) for i in range(3)])
    write = append_alerts(f"{tmp_path}/alerts", "large_amount", "a")
    for _ in range(2):
        write(detectors.large_amount(rows), 0)
    assert read_alerts(spark, f"{tmp_path}/alerts").count() == 3


def test_upsert_twice_gives_one_row(spark, tmp_path):
    base = 1_700_000_000_000
    path = f"{tmp_path}/stats"
    upsert_stats(path, "a")(stats.window_totals(frame(spark, [event("u", base, 0, 5)])), 0)
    upsert_stats(path, "a")(
        stats.window_totals(frame(spark, [event("u", base, 0, 5), event("u", base + 1, 1, 2.5)])), 1
    )
    stored = read_stats(spark, path).collect()
    assert [(float(r.total_amount), r.transaction_count, r.category) for r in stored] == [(7.5, 2, "ALL")]


def test_replay_table_streams_one_file(spark):
    stream = replay_table(spark, "/root/testdata/sf0.001", "events.parquet")
    assert stream.isStreaming and "props" in stream.columns


def test_the_input_is_read_once_for_all_results(spark, replayed, tmp_path):
    """Of ten queries one reads the input, the others the columns they need of the feed; results stay the same."""
    events, out, queries = replayed
    n = events.count()
    read = {name: sum(p["numInputRows"] for p in query.recentProgress) for name, query in queries.items()}
    assert read["feed"] == n and set(read.values()) == {n}
    for name, query in queries.items():
        of_feed = {s["description"] for p in query.recentProgress for s in p["sources"]}
        assert len(of_feed) == 1 and (f"{out}/events" in next(iter(of_feed))) == (name != "feed")
    alone = start_results(
        spark.readStream.schema(EVENT_SCHEMA).parquet(f"{out}/../in/*"), f"{tmp_path}", names=("failed_surge",),
        settings=SETTINGS, trigger=ONCE, shared=False,
    )
    alone["failed_surge"].awaitTermination()
    assert rows_of(read_alerts(spark, f"{tmp_path}/alerts")) == rows_of(read_alerts(spark, f"{out}/alerts/detector=failed_surge"))
    assert "feed" not in alone


@pytest.mark.parametrize("window", [5000, 50, 100_000])
def test_burst_state_by_blocks(window):
    """The processor alone, against the row-at-a-time rule: many triggers, events late by more than a window."""
    from tidewatch.streaming.stateful import Bursts

    class Value:
        value, calls = None, 0

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Blocks(dict):
        calls = 0

        def getValue(self, key):
            Blocks.calls += 1
            return self.get(key)

        def updateValue(self, key, value):
            Blocks.calls += 1
            self[key] = value

        def containsKey(self, key):
            return key in self

        def removeKey(self, key):
            del self[key]

    random.seed(window)
    rows = [event("u", 1_000_000 + seq * 37 - random.choice([0, 0, 0, 5, 900, 3000, window, 2 * window]), seq) for seq in range(3000)]
    processor = Bursts(window, 3, 0)
    processor._summary, processor._blocks, found, seq = Value(), Blocks(), [], 0
    most = 0
    while seq < len(rows):
        some = rows[seq : seq + random.randint(1, 60)]
        seq += len(some)
        frame_of = pd.DataFrame({"seq": [r[11] for r in some], "timestamp": [r[3] for r in some], "transaction_id": [r[4] for r in some]})
        before = Blocks.calls
        for out in processor.handleInputRows(("u",), iter([frame_of]), None):
            found += list(out.itertuples(index=False, name=None))
        if len(some) == 1:
            most = max(most, Blocks.calls - before)
        blocks, counts = processor._summary.value
        assert sorted(blocks) == blocks == sorted(k[0] for k in processor._blocks)
        assert counts == [sum(processor._blocks[b,][1]) for b in blocks]
    assert sorted(found) == arrival_model(rows, window, 3)
    assert most <= 4  # one event reads and writes the block it is in and the one that is leaving
