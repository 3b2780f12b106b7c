import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.brute import words
from tidewatch.llm.periodic_runs import find_runs, run_digests, runs, suffixes
from tidewatch.llm.queries import QUERIES


def brute_runs(w):
    """(start, length, period): for each period, the longest stretches that have it, unless a smaller one holds."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def altered(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [*w[:a], *(w[a + (i - a) % p] for i in range(a, len(w)))]


def brute(doc_id, text):
    w = altered(doc_id, text)
    found = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


@pytest.mark.parametrize("seed", range(40))
def test_suffix_order_and_common_beginnings(seed):
    draw = np.random.default_rng(seed)
    codes = draw.integers(0, draw.integers(1, 5), draw.integers(1, 120))
    order, common = suffixes(codes)
    whole = codes.tolist()
    assert sorted(order.tolist()) == list(range(len(codes)))
    for a, b, n in zip(order[:-1].tolist(), order[1:].tolist(), common[1:].tolist(), strict=True):
        x, y = whole[a:], whole[b:]
        same = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert n == same
    starts = [tuple(whole[a : a + 3]) for a in order.tolist()]
    assert len({(s, k) for k, s in enumerate(starts) if not k or starts[k - 1] != s}) == len(set(starts))


def made(draw):
    """Words over a small alphabet with runs, runs inside runs and broken runs."""
    out = []
    for _ in range(draw.randint(0, 8)):
        unit = [draw.choice("abc") for _ in range(draw.randint(1, 7))]
        if draw.random() < 0.4:
            unit *= draw.randint(2, 5)
            unit.append(draw.choice("abc"))
        out += (unit * draw.randint(1, 8))[: draw.randint(1, 60)]
        out += [draw.choice("abcd") for _ in range(draw.randint(0, 4))]
    return out


def test_runs_of_many_rows_at_once():
    draw = random.Random(11)
    for _ in range(150):
        rows = [made(draw) for _ in range(draw.randint(1, 12))]
        codes = np.array([ord(x) for r in rows for x in r], np.uint64)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        first = np.cumsum([0, *(len(r) for r in rows)])
        got = [[] for _ in rows]
        for s, n, q in find_runs(codes, owner, len(rows)).tolist():
            got[owner[s]].append((s - int(first[owner[s]]), n, q))
        assert got == [sorted(brute_runs(r), key=lambda x: (x[0], x[2])) for r in rows]


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        if len(words(d.text)) < 1500:
            assert got[d.doc_id] == brute(d.doc_id, d.text), d.doc_id
    assert sum(g[0] > 0 for g in got.values()) > 50


def test_odd_rows(spark):
    tens = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows = [
        (None, "a " * 9, 1), (None, None, 1), (1, "", 1), (2, " \n ", 1), (3, "x\ty x y x  y\nx y", 1), (3, "x\ty x y x  y\nx y", 1), (4, "a a a a a", 1), (5, "a a a a a a", 1),
        *((k, "one two three four five six seven", 1) for k in tens), (tens[0], "é 你 好", 1), (tens[1], "", 2), (7, "a b c d " * 3 + "a b c", 1), (8, "a b c d " * 4, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    got = sorted(str((r.doc_id, *tuple(r)[1:])) for r in run_digests(docs).collect())
    assert got == sorted(str((d, *brute(d, t))) for d, t, _ in rows)
    assert run_digests(docs.limit(0)).count() == 0
    listed = sorted(tuple(r) for r in runs(docs.where("doc_id in (3, 8)")).collect())
    assert listed == [(3, 0, 8, 2), (3, 0, 8, 2), (8, 0, 16, 4)]


def test_long_texts():
    """One word, a stretch, and nested stretches, in texts of many words."""
    n = 300_000
    for w in (np.zeros(n), np.arange(n) % 7, np.arange(n) % 1000 % 31, np.arange(n)):
        got = find_runs(w.astype(np.uint64), np.zeros(n, np.int64), 1).tolist()
        if w[1] == 0:
            assert got == [[0, n, 1]]
        elif w[-1] < 7:
            assert got == [[0, n, 7]]
        elif w[-1] < 31:
            assert [0, n, 1000] in got and len(got) == 301
        else:
            assert got == []


def test_slices_of_a_batch(spark):
    """Texts around the size of a slice, of which the last ones run into the next."""
    draw = random.Random(2)
    rows = [(k, " ".join(draw.choice("ab") for _ in range(draw.choice([10, 2000]))), 0) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x int").coalesce(1)
    got = {r.doc_id: tuple(r)[1:] for r in run_digests(docs).collect()}
    assert got == {d: brute(d, t) for d, t, _ in rows}
