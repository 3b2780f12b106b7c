import random

import pytest

from tests.llm.brute import linked, shingles
from tidewatch.llm.jaccard_join import JoinSettings, bands, keep_first, link

DOCS = "doc_id long, text string, n int, doc string, key string"


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], DOCS).repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in link(df).collect()}


def test_sample_matches_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = linked(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link(docs).collect()}
    assert got == {d: (len(shingles(t)), want[d]) for d, t in rows}
    assert len(set(want.values())) < len(rows)


def test_edited_copies_of_all_sizes(spark):
    """Copies at and around the threshold, with hot boilerplate in many texts and texts of one to 600 words."""
    rand = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    boiler = [rand.choice(vocab) for _ in range(30)]
    rows = []
    for i in range(260):
        n = rand.choice([1, 2, 4, 5, 6, 9, 14, 30, 70, 150, 330, 600])
        base = [rand.choice(vocab) for _ in range(n)]
        if i % 3 == 0:
            base = base + boiler
        rows.append((10 * i, " ".join(base)))
        for k in range(rand.randint(0, 2)):
            copy = list(base)
            for _ in range(int(len(base) * rand.choice([0, 0.01, 0.02, 0.03, 0.045]))):
                at = rand.randrange(len(copy))
                copy[at : at + 1] = rand.choice([[], ["new"], ["new", copy[at]]])
            rows.append((10 * i + k + 1, rand.choice([" ", "\n", "  "]).join(copy)))
    want = linked(rows)
    assert len(set(want.values())) < len(rows) - 40
    assert run(spark, rows) == {d: (len(shingles(t)), want[d]) for d, t in rows}


def test_group_of_near_copies_and_bridges(spark):
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate(range(0, 200, 2))]
    rows += [(1000 + i, " ".join(base[i * 6 :] + [f"t{k}" for k in range(i * 6)])) for i in range(12)]
    want = linked(rows)
    assert run(spark, rows) == {d: (len(shingles(t)), want[d]) for d, t in rows}


def test_nulls_blanks_ties_and_long_texts(spark):
    long = " ".join(f"u{i}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, long), (7, long + " more"), (8, "é b")]
    got = run(spark, rows)
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (299_996, 6), 7: (299_997, 6), 8: (1, 8)}


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "a b c"), (1, "a b c"), (2, "d e f"), (2, "d e f"), (3, "d e f")]
    df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], DOCS)
    got = sorted(((r.doc_id, r.component_id) for r in link(df).collect()), key=str)
    assert got == [(1, 1), (2, 2), (2, 2), (3, 2), (None, None)]
    kept = keep_first(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, None]
    assert link(df.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_bands_keep_the_pigeonhole(percent):
    for band in bands(JoinSettings(percent=percent), 5000):
        partner = band.high * 100 // percent
        apart = max(
            a + b - 2 * common
            for a in range(band.low, band.high + 1, max(1, (band.high - band.low) // 5))
            for b in range(a, min(partner, a * 100 // percent) + 1, max(1, a // 9))
            for common in [-(-percent * (a + b) // (100 + percent))]
        )
        assert band.exact + 2 * band.loose >= apart + 1 + band.spare
