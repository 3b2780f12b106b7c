"""The processors of the stateful detectors on their own, over a state that counts its calls."""

import random

import pandas as pd

from tests.test_streaming import arrival_model
from tidewatch.streaming.stateful import Bursts, Growth


class State:
    """A map, list or value state in memory."""

    def __init__(self, calls):
        self.rows, self.calls = {}, calls

    def _call(self, name):
        self.calls.append(name)

    def getValue(self, key):
        self._call("get")
        return self.rows.get(key)

    def containsKey(self, key):
        self._call("contains")
        return key in self.rows

    def updateValue(self, key, value):
        self._call("update")
        self.rows[key] = value

    def removeKey(self, key):
        self._call("remove")
        del self.rows[key]

    def get(self):
        self._call("get")
        return self.rows.get("value", ())

    def update(self, value):
        self._call("update")
        self.rows["value"] = value

    put = update

    def clear(self):
        self._call("clear")
        self.rows.clear()


class Handle:
    def __init__(self):
        self.calls, self.states = [], {}

    def _state(self, name, *_):
        return self.states.setdefault(name, State(self.calls))

    getMapState = getValueState = getListState = _state


def trigger(processor, events):
    """What a processor finds in a batch of (user, timestamp, seq, amount) of one group."""
    names = ["user_id", "timestamp", "seq", "amount"]
    rows = pd.DataFrame(events, columns=names)
    rows["transaction_id"] = [f"t{seq}" for seq in rows["seq"]]
    half = len(rows) // 2
    found = processor.handleInputRows(("u0",), iter([rows[:half], rows[half:]]), None)
    return [tuple(row) for df in found for row in df.itertuples(index=False)]


def test_a_user_costs_two_state_calls_a_trigger():
    hour = 3_600_000
    for processor in (Bursts(24 * hour, 3, 0), Growth(3, 1.1)):
        handle = Handle()
        processor.init(handle)
        for day in range(3):
            handle.calls.clear()
            trigger(processor, [("u0", (24 * day + i) * hour, 24 * day + i, 1.0) for i in range(24)])
            assert len(handle.calls) <= 2, handle.calls


def test_users_of_one_group_are_followed_apart():
    processor = Growth(3, 1.1)
    processor.init(Handle())
    first = trigger(processor, [("a", 1, 1, 10.0), ("b", 2, 2, 99.0), ("a", 3, 3, 20.0), ("b", 4, 4, 5.0)])
    second = trigger(processor, [("b", 5, 5, 6.0), ("a", 6, 6, 40.0), ("b", 7, 7, 7.0)])
    assert first == []
    assert sorted(second) == [("a", "t6", 6, 40.0, [10.0, 20.0, 40.0]), ("b", "t7", 7, 7.0, [5.0, 6.0, 7.0])]


def test_bursts_in_one_entry_and_in_blocks_count_alike():
    random.seed(5)
    for inline in (0, 3, 8, 256):
        processor, handle = Bursts(640, 2, 0), Handle()
        processor.INLINE = inline
        processor.init(handle)
        clock, rows, found = 0, [], []
        for number in range(30):
            batch = []
            for _ in range(random.choice([1, 5, 25])):
                clock += random.choice([0, 1, 7, 60, 900])
                late = random.choice([0, 0, 0, 30, 700, 5000])
                batch.append((random.choice("ab"), clock - late, len(rows) + len(batch), 1.0))
            rows += batch
            found += trigger(processor, random.sample(batch, len(batch)))
            users, blocks = handle.states["users"].rows, handle.states["blocks"].rows
            assert blocks.keys() == {(user[0], block) for user, row in users.items() for block in row[0]}, number
        assert sorted(found) == arrival_model([(user, 0, 0, at) for user, at, _, _ in rows], 640, 2)
