"""The two detectors that follow each user through a stream.

Events of a user are taken in arrival order (``seq``; by time and id where there is none). A micro-batch
hands a user's rows to one task, so the source's limit per trigger is what bounds it; the state itself is
small: one row per millisecond of the window, or the last amounts.

What a call of a processor costs beside its work, some milliseconds, is not paid per user: users are dealt to
``BUCKETS`` groups. Nor is a call of the state, a quarter of a millisecond: the users of a group lie on ``SHELVES``
shelves, each an entry of the group's state. A trigger reads and writes the shelves that it has users of, with all that
lies there, and touches no other.
"""

from __future__ import annotations

import sys
import zlib
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.detectors import burst_alerts, growth_alerts
from tidewatch.settings import DEFAULTS, RiskSettings

# The processors travel to the Python workers as they are, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The state is kept by both, so a checkpoint holds for one pair of numbers.
BUCKETS = 512  # groups of users
SHELVES = 16  # of a group


def _by_bucket(events: DataFrame, *columns: str) -> GroupedData:
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    known = events.where("user_id IS NOT NULL")
    return known.select(bucket, "user_id", *map(F.expr, ("coalesce(seq, -1) AS seq", "timestamp", *columns))).groupBy("bucket")


def _arrivals(rows: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple[int, list[tuple[str, list[tuple]]]]]:
    """The shelves that a batch has users of, each with these users and their rows in order of arrival, as (seq,
    timestamp, *columns).

    Plain tuples: most users have a handful of rows in a batch, where DataFrame operations cost more than
    the work itself.
    """
    users = defaultdict(list)
    for chunk in rows:
        events = zip(*(chunk[c].tolist() for c in ("seq", "timestamp", *columns)))
        for user, event in zip(chunk["user_id"].tolist(), events):
            users[user].append(event)
    shelves = defaultdict(list)
    for user, events in users.items():
        events.sort()
        shelves[zlib.crc32(user.encode()) % SHELVES].append((user, events))
    yield from shelves.items()


def _pieces(values: Sequence, sizes: Sequence[int]) -> Iterator[list]:
    """Lists of the given sizes that lie one after the other."""
    begin = 0
    for size in sizes:
        yield list(values[begin : begin + size])
        begin += size


class Bursts(StatefulProcessor):
    """Counts a user's events within the window before each one.

    Every event drops what left the window by its own time, for good; an older event that arrives later, however late,
    counts the newer ones that are there. On the shelf lie a user's milliseconds of the window with the events of each, as
    long as these are ``INLINE`` at most. Beyond that the user has an entry of its own, a summary which blocks of time have
    how many events, and the milliseconds lie in an entry per block: a trigger reads and writes the summary and the blocks
    that something arrives in or leaves in part; blocks that leave whole are only struck off; the shelf has no millisecond
    then. All of it goes when the user has not been heard of for ``idle_ms``, if that is given.
    """

    BLOCKS = 64  # in a window
    INLINE = 256  # milliseconds

    def __init__(self, window_ms: int, least: int, idle_ms: int):
        self._window = window_ms
        self._least = least
        self._idle = idle_ms
        self._width = max(1, window_ms // self.BLOCKS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        events, kept = "times array<bigint>, arrivals array<bigint>", self._idle or None
        shelf = f"users array<string>, heard array<bigint>, sizes array<int>, {events}"
        self._shelves = handle.getMapState("shelves", "shelf int", shelf, kept)
        self._users = handle.getMapState("users", "user_id string", "blocks array<bigint>, counts array<bigint>", kept)
        self._blocks = handle.getMapState("blocks", "user_id string, block bigint", events, kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() if self._idle else 0
        found = []
        for shelf, users in _arrivals(rows):
            held = self._taken(shelf, now)
            for user, events in users:
                _, times, arrivals = held.get(user, (now, [], []))
                apart = user in held and not times
                arriving = [at for _, at in events]
                if not apart and len(times) + len(arriving) <= self.INLINE:
                    bursts, times, arrivals = self._follow_few(arriving, times, arrivals)
                else:
                    bursts, times, arrivals = self._follow(user, arriving, times, arrivals, apart)
                found.extend((user, at, count) for at, count in bursts)
                held[user] = now, times, arrivals
            self._put(shelf, held)
        if found:
            yield pd.DataFrame(found, columns=["user_id", "timestamp", "transaction_count"])

    def _taken(self, shelf: int, now: int) -> dict[str, tuple[int, list[int], list[int]]]:
        """What lies on a shelf: of each user when it was heard of, the milliseconds and their events, none of a user with
        blocks."""
        users, heard, sizes, times, arrivals = self._shelves.getValue((shelf,)) or ([], [], [], [], [])
        entries = zip(users, heard, _pieces(times, sizes), _pieces(arrivals, sizes), strict=True)
        return {user: (at, *events) for user, at, *events in entries if not self._idle or at + self._idle > now}

    def _put(self, shelf: int, held: dict[str, tuple[int, list[int], list[int]]]) -> None:
        heard, times, arrivals = zip(*held.values())
        sizes = [len(events) for events in times]
        self._shelves.updateValue((shelf,), (list(held), list(heard), sizes, list(chain(*times)), list(chain(*arrivals))))

    def _follow_few(
        self, arriving: list[int], times: list[int], arrivals: list[int]
    ) -> tuple[list[tuple[int, int]], list[int], list[int]]:
        """The same as ``_follow`` for a user whose milliseconds stay on the shelf whatever leaves."""
        counts = dict(zip(times, arrivals, strict=True))
        times, first, in_window, found = sorted(counts), 0, sum(arrivals), []
        for at in arriving:
            while first < len(times) and times[first] <= at - self._window:
                in_window -= counts.pop(times[first])
                first += 1
            if at not in counts:
                insort(times, at, first)
            counts[at] = counts.get(at, 0) + 1
            in_window += 1
            if in_window >= self._least:
                found.append((at, in_window))
        times = times[first:]
        return found, times, [counts[at] for at in times]

    def _follow(
        self, user: str, arriving: list[int], times: list[int], arrivals: list[int], apart: bool
    ) -> tuple[list[tuple[int, int]], list[int], list[int]]:
        """Take up a user's events; the times at which enough are in the window, with their number, and what is to lie on
        the shelf."""
        blocks, numbers = (self._users.getValue((user,)) if apart else None) or ([], [])
        blocks = list(blocks)  # ascending
        counts = dict(zip(blocks, numbers, strict=True))
        apart = set(blocks)  # blocks with an entry of their own
        held: dict[int, dict[int, int]] = {}  # blocks that were read: events by millisecond
        for time, number in zip(times, arrivals, strict=True):
            block = time // self._width
            held.setdefault(block, {})[time] = number
            counts[block] = counts.get(block, 0) + number
        blocks = blocks or sorted(held)
        in_window = sum(counts.values())
        changed, found = set(held), []

        def read(block: int) -> dict[int, int]:
            if block not in held:
                row = self._blocks.getValue((user, block)) if block in counts else None
                held[block] = dict(zip(row[0], row[1], strict=True)) if row else {}
            return held[block]

        def strike(block: int) -> None:
            blocks.remove(block)
            del counts[block]
            held.pop(block, None)
            changed.add(block)

        for at in arriving:
            left = at - self._window  # this millisecond and all before have left
            while blocks and blocks[0] * self._width + self._width - 1 <= left:
                in_window -= counts[blocks[0]]
                strike(blocks[0])
            if blocks and blocks[0] * self._width <= left:
                first = blocks[0]
                events = read(first)
                for time in [t for t in events if t <= left]:
                    gone = events.pop(time)
                    in_window -= gone
                    counts[first] -= gone
                    changed.add(first)
                if not events:
                    strike(first)
            block = at // self._width
            events = read(block)
            if block not in counts:
                insort(blocks, block)
                counts[block] = 0
            events[at] = events.get(at, 0) + 1
            counts[block] += 1
            changed.add(block)
            in_window += 1
            if in_window >= self._least:
                found.append((at, in_window))
        return found, *self._keep(user, blocks, counts, held, changed, apart)

    def _keep(
        self, user: str, blocks: list, counts: dict, held: dict, changed: set, apart: set
    ) -> tuple[list[int], list[int]]:
        events = []
        if all(b in held for b in blocks) and 0 < sum(len(held[b]) for b in blocks) <= self.INLINE:
            events = [event for b in blocks for event in held[b].items()]
            gone = apart
            if apart:
                self._users.removeKey((user,))
        else:
            for block in changed & counts.keys():
                self._blocks.updateValue((user, block), (list(held[block]), list(held[block].values())))
            self._users.updateValue((user,), (blocks, [counts[b] for b in blocks]))
            gone = apart - counts.keys()
        for block in gone:
            if self._blocks.containsKey((user, block)):
                self._blocks.removeKey((user, block))
        return [at for at, _ in events], [n for _, n in events]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from ()

    def close(self) -> None:
        pass


class Growth(StatefulProcessor):
    """Keeps the amounts of a user's present run; a full run is an alert and starts the count anew."""

    def __init__(self, length: int, factor: float):
        self._length = length
        self._factor = factor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._shelves = handle.getMapState("shelves", "shelf int", "users array<string>, sizes array<int>, amounts array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = []
        for shelf, users in _arrivals(rows, "transaction_id", "amount"):
            names, sizes, amounts = self._shelves.getValue((shelf,)) or ([], [], [])
            runs = dict(zip(names, _pieces(amounts, sizes), strict=True))
            for user, events in users:
                run = runs.get(user, [])
                for _, at, transaction_id, amount in events:
                    if run and amount >= run[-1] * self._factor:
                        run.append(amount)
                    else:
                        run = [amount]
                    if len(run) == self._length:
                        found.append((user, transaction_id, at, amount, run))
                        run = []
                runs[user] = run
            runs = {user: run for user, run in runs.items() if run}
            if runs:
                kept = (list(runs), [len(run) for run in runs.values()], list(chain(*runs.values())))
                self._shelves.updateValue((shelf,), kept)
            elif names:
                self._shelves.removeKey((shelf,))
        if found:
            names = ["user_id", "transaction_id", "timestamp", "amount", "amounts"]
            yield pd.DataFrame(found, columns=names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from ()

    def close(self) -> None:
        pass


def stream_high_frequency(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Streaming form of ``high_frequency``. Late events count as well, whatever the watermark; a user's state is
    forgotten after ``burst_idle_ms`` without an event, by the clock of the cluster, or kept if that is 0. A query that
    forgets by the clock never runs out of work, so one that is to end when its input does needs 0."""
    bursts = _by_bucket(events).transformWithStateInPandas(
        statefulProcessor=Bursts(settings.burst_window_ms, settings.burst_count, settings.burst_idle_ms),
        outputStructType="user_id string, timestamp bigint, transaction_count bigint",
        outputMode="append",
        timeMode="processingTime" if settings.burst_idle_ms else "none",
    )
    return burst_alerts(bursts, settings)


def stream_continuous_increase(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Streaming form of ``continuous_increase``. Nothing is too late for it, and there is no time limit
    between the events of a run."""
    runs = _by_bucket(events, "coalesce(transaction_id, '') AS transaction_id", "amount").transformWithStateInPandas(
        statefulProcessor=Growth(settings.growth_length, settings.growth_factor),
        outputStructType="user_id string, transaction_id string, timestamp bigint, amount double, amounts array<double>",
        outputMode="append",
        timeMode="none",
    )
    return growth_alerts(runs, settings)
