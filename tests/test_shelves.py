"""State of the stateful detectors by shelves of users, and arrivals in many files."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_stateful import Handle, trigger
from tidewatch.sources.files import write_arrivals
from tidewatch.streaming.stateful import SHELVES, Bursts, Growth

DAY = 86_400_000


@pytest.mark.parametrize("processor", [Bursts(DAY, 3, 0), Growth(3, 1.1)])
def test_users_of_a_shelf_cost_two_state_calls_together(processor):
    handle = Handle()
    processor.init(handle)
    for day in range(3):
        handle.calls.clear()
        trigger(processor, [(f"u{k}", day * DAY + k, 1000 * day + k, 1.0) for k in range(500)])
        assert len(handle.calls) <= 2 * SHELVES


def test_a_shelf_keeps_the_users_a_trigger_does_not_name():
    bursts, growth = Bursts(DAY, 3, 0), Growth(3, 1.1)
    names = [f"u{k}" for k in range(100)]
    for processor in (bursts, growth):
        processor.init(Handle())
        for place, amount in enumerate((1.0, 2.0)):  # half of the users at a time
            for half in (names[:50], names[50:]):
                assert not trigger(processor, [(u, place, 100 * place + k, amount) for k, u in enumerate(half)])
    assert sorted(trigger(bursts, [(u, 5, 900, 4.0) for u in names])) == sorted((u, 5, 3) for u in names)
    found = trigger(growth, [(u, 5, 900, 4.0) for u in names])
    assert sorted(found) == sorted((u, "t900", 5, 4.0, [1.0, 2.0, 4.0]) for u in names)
    assert not trigger(growth, [(u, 6, 901, 9.0) for u in names])  # runs begin anew


class Clock:
    def __init__(self, now):
        self.getCurrentProcessingTimeInMs = lambda: now


def test_users_of_a_shelf_are_forgotten_each_by_itself():
    import pandas as pd

    processor, handle = Bursts(DAY, 2, 1000), Handle()
    processor.init(handle)
    names = [f"u{k}" for k in range(50)]

    def arrive(now, users, seq):
        rows = pd.DataFrame({"user_id": users, "timestamp": seq, "seq": seq, "transaction_id": "t"})
        found = processor.handleInputRows((0,), iter([rows]), Clock(now))
        return sorted(u for df in found for u in df["user_id"])

    assert arrive(0, names, 1) == []
    assert arrive(900, names[:25], 2) == sorted(names[:25])
    assert arrive(1500, names, 3) == sorted(names[:25])  # the others were last heard of 1500 ms before
    assert arrive(1600, names, 4) == sorted(names)
    kept = [u for row in handle.states["shelves"].rows.values() for u in row[0]]
    assert sorted(kept) == sorted(names)


def test_arrivals_in_many_files_keep_every_row(spark, tmp_path):
    rows = spark.range(3000).select("id", (F.col("id") % 3).alias("arrival"), F.struct("id").alias("seq"))
    write_arrivals(rows, "arrival", str(tmp_path), range(3), 6)
    for number in range(3):
        files = [pq.read_table(f).num_rows for f in glob.glob(f"{tmp_path}/arrival-{number}/*.parquet")]
        assert len(files) == 6 and min(files) > 0 and sum(files) == 1000
    assert spark.read.parquet(f"{tmp_path}/arrival-*").distinct().count() == 3000


def test_few_events_and_blocks_count_alike():
    """Users who stay on the shelf whatever leaves are followed by a shorter way."""
    random.seed(1)
    for inline in (4, 30, 256) * 10:
        window, least = random.choice([5, 50, 640, 5000]), random.choice([1, 2, 3])
        few, blocks = Bursts(window, least, 0), Bursts(window, least, 0)
        few.INLINE, blocks.INLINE, ways = inline, 0, []
        short = few._follow_few
        few._follow_few = lambda *events, short=short, ways=ways: (ways.append(1), short(*events))[1]
        for processor in (few, blocks):
            processor.init(Handle())
        clock = seq = 0
        for _ in range(15):
            batch = []
            for _ in range(random.choice([1, 4, 20])):
                clock, seq = clock + random.choice([0, 1, 7, 60, 900]), seq + 1
                batch.append((random.choice("ab"), clock - random.choice([0, 0, 0, 30, 700, 5000]), seq, 1.0))
            assert sorted(trigger(few, batch)) == sorted(trigger(blocks, batch))
        assert ways or inline < 30
