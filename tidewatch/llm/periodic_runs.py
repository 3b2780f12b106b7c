"""Runs of a text: stretches of words that repeat with a period at least four times over, and texts without them.

The suffixes of each text are sorted by doubling, and their LCP-interval tree is walked from the leaves up. A node
stands for a stretch of ``m`` words and holds the places where it begins, in order, each with the word to its left as
its class. Two places of one node are a maximal pair if neither the words before them nor those after the stretch
agree. A run of period q and length n is such a pair: the places s and s + q at the node of n - q words. The other way
round, a maximal pair of neighbouring places at a distance d of at most a third of m is a run of period d and length
m + d: it can't be longer, as the pair is maximal, and it has no smaller period, as the stretch would then begin in
between as well. So each run is met exactly once, where its two places come together, and nothing has to be extended.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.textbytes import Texts, in_row, span_hashes, texts

TIMES, SHORTEST = 4, 6  # a run is at least so many periods and so many words long
_NODE = 5  # words of the smallest node that can hold a run: one of period 1
_WORDS = 1 << 17  # words joined at a time

_Pairs = list[tuple[int, int, int]]


def suffixes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a sequence in an order that keeps equal beginnings together, and how many items each has in
    common with the one before it. Items that differ between texts never agree, so no end needs a mark of its own but
    the last."""
    n = len(codes)
    order = np.argsort(codes, kind="stable").astype(np.int32)
    rank, levels, width = np.empty(n + 1, np.int32), [], 1
    rank[n] = -1
    fresh = np.append(True, codes[order[1:]] != codes[order[:-1]])
    slots = np.arange(n, dtype=np.int32)
    while True:
        first = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        rank[order[slots]] = first
        levels.append(rank.copy())
        last = np.append(fresh[1:], True)
        slots = slots[~(fresh & last)]
        if not len(slots):
            break
        some = order[slots]
        keys = rank[some].astype(np.int64) * (n + 1) + rank[np.minimum(some + width, n)] + 1
        sort = np.argsort(keys, kind="stable")
        order[slots] = some[sort]
        keys = keys[sort]
        fresh = np.append(True, keys[1:] != keys[:-1])
        width *= 2
    common = np.zeros(n, np.int32)
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b, found = order[at - 1], order[at], np.zeros(len(at), np.int32)
    for k in range(len(levels) - 1, -1, -1):
        ranks = levels[k]
        found += np.where(ranks[a + found] == ranks[b + found], np.int32(1 << k), np.int32(0))
    common[at] = found
    return order, common


class _Tree:
    """The maximal pairs of neighbouring places below one node of ``_NODE`` words."""

    def __init__(self, codes: list[int]):
        self.codes = codes  # a code that no word has stands before and after each text
        self.found: _Pairs = []

    def _pair(self, i: int, j: int, m: int) -> None:
        d, codes = j - i, self.codes
        if (TIMES - 1) * d <= m and m + d >= SHORTEST and codes[i - 1] != codes[j - 1] and codes[i + m] != codes[j + m]:
            self.found.append((i, m + d, d))

    def _node(self, m: int, children: list[list[int]]) -> list[int]:
        """The places of a node, from those of its children; pairs that come together here are looked at."""
        places = max(children, key=len)
        moved = [p for c in children if c is not places for p in c]
        if 16 * len(moved) > len(places):
            places += moved
            places.sort()
        else:
            for p in moved:
                insort(places, p)
        for p in moved:
            k = bisect_left(places, p)
            if k:
                self._pair(places[k - 1], p, m)
            if k + 1 < len(places):
                self._pair(p, places[k + 1], m)
        return places

    def walk(self, places: list[int], common: list[int]) -> None:
        """From the leaves up; ``common[k]`` is what place k shares with the one before it in suffix order."""
        open_nodes: list[tuple[int, list[list[int]]]] = []
        for k in range(1, len(places) + 1):
            node, m = [places[k - 1]], common[k] if k < len(places) else -1
            while open_nodes and open_nodes[-1][0] > m:
                depth, children = open_nodes.pop()
                children.append(node)
                node = self._node(depth, children)
            if open_nodes and open_nodes[-1][0] == m:
                open_nodes[-1][1].append(node)
            else:
                open_nodes.append((m, [node]))


def find_runs(codes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """All runs in the words of some rows: start (in ``codes``), length and period, by start, then period.

    ``codes`` are equal where words of a row are equal. Nodes below which no two places are near enough, or all have
    the same left word, can hold no run and are not walked.
    """
    none = np.zeros((0, 3), np.int64)
    if len(codes) < SHORTEST:
        return none
    # one item after each row that is in no other place, and one before all
    at = np.arange(len(codes)) + rows + 1
    _, dense = np.unique(in_row(codes, rows), return_inverse=True)
    items = np.arange(len(codes), len(codes) + len(codes) + n_rows + 1)
    items[at] = dense
    order, common = suffixes(items)
    deep = common >= _NODE
    edges = np.diff(np.append(deep, False).astype(np.int8), prepend=0)
    begins, ends = np.flatnonzero(edges == 1) - 1, np.flatnonzero(edges == -1)  # [begin, end) in suffix order
    if not len(begins):
        return none
    sizes = ends - begins
    inside = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    group, place = np.repeat(np.arange(len(begins)), sizes), order[inside].astype(np.int64)
    firsts = np.cumsum(sizes) - sizes
    deepest = np.maximum.reduceat(np.where(deep[inside], common[inside], 0), firsts)
    left = items[place - 1]
    mixed = np.maximum.reduceat(left, firsts) != np.minimum.reduceat(left, firsts)
    sort = np.argsort(group * len(items) + place)
    gaps = np.diff(place[sort], prepend=0)
    gaps[firsts] = len(items)
    near = (TIMES - 1) * np.minimum.reduceat(gaps, firsts) <= deepest
    keep = np.flatnonzero(mixed & near)
    if not len(keep):
        return none
    tree = _Tree(items.tolist())
    for begin, end in zip(begins[keep].tolist(), ends[keep].tolist(), strict=True):
        tree.walk(order[begin:end].tolist(), common[begin:end].tolist())
    runs = np.array(sorted({(i, d, n) for i, n, d in tree.found}), np.int64).reshape(-1, 3)
    word = np.full(len(items), -1)
    word[at] = np.arange(len(codes))
    return np.column_stack([word[runs[:, 0]], runs[:, 2], runs[:, 1]])


def _altered(ids: Iterable[str | None], counts: np.ndarray) -> np.ndarray:
    """Which of the words stands at each place: itself, but for a tenth of the documents, chosen by id, whose end
    repeats a stretch of itself."""
    source = np.arange(int(counts.sum()))
    for id, begin, n in zip(ids, (np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
        if id is None or not n:
            continue
        h = zlib.crc32(id.encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[begin + a : begin + n] = begin + a + np.arange(n - a) % p
    return source


def _joined(part: Texts, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Row and bytes of the given words, a space after each, in pieces."""
    raw = np.append(part.data, np.uint8(32))
    for a in range(0, len(starts), _WORDS):
        s, e, r = starts[a : a + _WORDS], ends[a : a + _WORDS], rows[a : a + _WORDS]
        total = np.cumsum(e - s + 1)
        take = np.repeat(s - total + (e - s + 1), e - s + 1) + np.arange(total[-1])
        take[total - 1] = len(part.data)
        out = raw[take].tobytes()
        cuts = np.append(np.flatnonzero(np.diff(r)), len(r) - 1)
        begin = 0
        for row, end in zip(r[cuts].tolist(), total[cuts].tolist(), strict=True):
            yield row, out[begin:end]
            begin = end


def _digest(pieces: Iterator[tuple[int, bytes]], n_rows: int) -> list[str]:
    """The digest of each row's words, without the space after the last."""
    sums = [None] * n_rows
    current, space = -1, b""
    for row, piece in pieces:
        if row != current:
            current, space = row, b""
            sums[row] = hashlib.sha256()
        sums[row].update(space + piece[:-1])
        space = b" "
    return [(s or hashlib.sha256()).hexdigest() for s in sums]


def _part_runs(part: Texts, ids: list[str | None], alter: bool):
    """Words (start, end, row) of the rows as altered, first word and number of words of each row, and all runs."""
    starts, ends, rows = part.words()
    counts = np.bincount(rows, minlength=part.rows)
    if alter:
        source = _altered(ids, counts)
    else:
        source = np.arange(len(starts))
    codes = span_hashes(part.data, starts, ends)[source]
    return starts[source], ends[source], rows, counts, find_runs(codes, rows, part.rows)


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"), docs[id].cast("string").alias("key"))


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start, length, period) of every run of every text, numbers in words from 0. Texts without a run, null and
    empty ones give no row; repeated rows give theirs again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in texts(batch.column(1)):
                _, _, rows, counts, found = _part_runs(some, [], False)
                owner = rows[found[:, 0]] if len(found) else np.zeros(0, np.int64)
                first = np.cumsum(counts) - counts
                columns = [found[:, 0] - first[owner], found[:, 1], found[:, 2]]
                owners = batch.column(0).take(pa.array(some.first + owner))
                yield pa.RecordBatch.from_arrays([owners, *map(pa.array, columns)], [id, "start", "length", "period"])

    rows = _rows(docs, id, text)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, start long, length long, period long")


def run_digests(docs: DataFrame, id: str = "doc_id", text: str = "text", alter: bool = True) -> DataFrame:
    """One row per document: its runs, the longest of them, and digests of all runs and of the text without them.

    With ``alter`` the end of a tenth of the texts, chosen by the decimal id, is first made periodic. Columns are the
    id, n_runs, start, length, period and exponent_milli of the longest run (the first of several, then that of the
    smallest period), runs_sha256 of the lines ``start,length,period`` and collapsed_sha256 of the words that are in
    no run after its first period, joined by one space.

    Null, empty and blank texts and those without a run have no longest run and no lines. A null id is not altered;
    repeated rows give a row each; an empty table gives none; other columns are not read. A text is worked on as a
    whole, in memory of some hundred times its number of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in texts(batch.column(1)):
                ids = batch.column(2).slice(some.first, some.rows).to_pylist()
                starts, ends, rows, counts, found = _part_runs(some, ids, alter)
                first = np.cumsum(counts) - counts
                dropped = np.zeros(len(starts) + 1, np.int64)
                np.add.at(dropped, found[:, 0] + found[:, 2], 1)
                np.add.at(dropped, found[:, 0] + found[:, 1], -1)
                kept = np.cumsum(dropped[:-1]) == 0
                collapsed = _digest(_joined(some, starts[kept], ends[kept], rows[kept]), some.rows)
                lines: list[list[tuple[int, int, int]]] = [[] for _ in range(some.rows)]
                for start, length, period in found.tolist():
                    row = int(rows[start])
                    lines[row].append((start - int(first[row]), length, period))
                best = [min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None, None, None) for r in lines]
                listed = ["".join(f"{s},{n},{p}\n" for s, n, p in r) for r in lines]
                columns = [
                    pa.array([len(r) for r in lines], pa.int64()),
                    *(pa.array([b[k] for b in best], pa.int64()) for k in range(3)),
                    pa.array([1000 * b[1] // b[2] if b[2] else None for b in best], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]),
                    pa.array(collapsed),
                ]
                owners = batch.column(0).slice(some.first, some.rows)
                yield pa.RecordBatch.from_arrays([owners, *columns], names)

    rows = _rows(docs, id, text)
    names = [id, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kind = rows.schema["id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in names[1:6])
    return rows.mapInArrow(run, f"`{id}` {kind}, {numbers}, runs_sha256 string, collapsed_sha256 string")
