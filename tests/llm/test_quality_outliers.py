import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import base_counts
from tidewatch.llm.quality_outliers import OutlierSettings, _chi2_cdf, chi2_quantile, estimate, judge, keep_good
from tidewatch.llm.queries import QUERIES

COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_and_base_rules_on_the_sample(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op3_quality_outliers"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base_counts(texts[r.doc_id])
        assert {c: r[c] for c in COUNTED} == want
        assert r.base_failed == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])
        assert not (r.base_failed and r.kept)


def test_labels_of_the_sample(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = QUERIES["op3_quality_outliers"](spark, folder).where("not base_failed").join(labels, "doc_id")
    shares = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.99 and shares[0] < 0.1


def _group(rand, n, junk, spoil):
    """Texts of which those with a number in ``junk`` are spoilt alike."""
    word = lambda: "".join(rand.choice("abcdefgh") for _ in range(rand.randint(2, 9)))
    rows = []
    for i in range(n):
        lines = [[word() for _ in range(8)] for _ in range(8)]
        rows.append((i, "en", "one", spoil(lines, rand) if i in junk else "\n".join(" ".join(w) for w in lines) + "."))
    return rows


def _upper(lines, rand):
    return "\n".join(" ".join(x.upper() + "!!" for x in w) for w in lines)


def _symbols(lines, rand):
    return "\n".join(" ".join(x + "#$%" if rand.random() < 0.5 else x for x in w) for w in lines)


def _repeated_lines(lines, rand):
    """85 % or more of the lines are repeats, in an order that leaves few windows of eight words twice."""
    short = [" ".join(w[:2]) for w in lines[:5]]
    return "\n".join(rand.choice(short) for _ in range(60))


@pytest.mark.parametrize("spoil", [_upper, _symbols, _repeated_lines])
def test_one_hot_group_with_more_than_a_third_of_like_junk(spark, spoil):
    n = 900
    junk = {i for i in range(n) if i % 20 < 7}
    df = spark.createDataFrame(_group(random.Random(1), n, junk, spoil), "doc_id long, lang string, source string, text string")
    df = df.repartition(7)
    kept = {r.doc_id for r in keep_good(df).collect()}
    assert not kept & junk
    assert len(kept) >= 0.97 * (n - len(junk))


def _numpy_least(x, share, floors, rand):
    """The least determinant found from 60 random starts, sorting all distances; then the fit to usual rows."""
    p, h = x.shape[1], int(np.ceil(share * len(x)))
    scale = share / _chi2_cdf(chi2_quantile(share, p), p + 2)
    best = (np.inf, None, None)
    for _ in range(60):
        some = x[rand.choice(len(x), p + 1, replace=False)]
        centre, spread, last = some.mean(0), np.cov(some.T, bias=True) + np.diag(floors**2), np.inf
        while True:
            off = x - centre
            closest = x[np.argsort(np.einsum("ij,jk,ik->i", off, np.linalg.inv(spread), off), kind="stable")[:h]]
            centre, spread = closest.mean(0), scale * np.cov(closest.T, bias=True) + np.diag(floors**2)
            det = np.linalg.slogdet(spread)[1]
            if det >= last - 1e-9:
                break
            last = det
        if det < best[0]:
            best = (det, centre, spread)
    det, centre, spread = best
    off = x - centre
    usual = x[np.einsum("ij,jk,ik->i", off, np.linalg.inv(spread), off) <= chi2_quantile(0.975, p)]
    spread = 0.975 / _chi2_cdf(chi2_quantile(0.975, p), p + 2) * np.cov(usual.T, bias=True) + np.diag(floors**2)
    off = x - usual.mean(0)
    return det, np.einsum("ij,jk,ik->i", off, np.linalg.inv(spread), off)


@pytest.mark.parametrize("few", [100_000, 0])
def test_estimates_against_random_starts(spark, few):
    rand = np.random.default_rng(3)
    mix = rand.normal(size=(5, 5))
    clean = rand.normal(size=(1300, 5)) @ mix * 0.1 + 1
    # Tight, but so far off that no half of all rows with it has a small determinant.
    junk = rand.normal(size=(700, 5)) * 0.05 + [3.0, 1.2, 2.4, 1.4, -0.4]
    x = np.concatenate([clean, junk])
    settings = OutlierSettings(broadcast_levels=few, salts=3)
    vectors = spark.createDataFrame([(["one", ""], row.tolist()) for row in x], "levels array<string>, x array<double>")
    found = {r.level: r for r in estimate(vectors.repartition(5), settings).collect()}
    assert set(found) == {"one", ""} and found["one"].n == 2000
    _, want = _numpy_least(x, settings.share, np.array(settings.floors), rand)
    off = x - np.array(found["one"].centre)
    got = np.einsum("ij,jk,ik->i", off, np.array(found["one"].inverse).reshape(5, 5), off)
    assert np.abs(got / want - 1).max() < 0.1
    limit = chi2_quantile(1 - settings.tail, 5)
    clear = np.abs(want / limit - 1) > 0.1
    assert ((got <= limit) == (want <= limit))[clear].all()
    assert (got[:1300] <= limit).mean() > 0.99


def test_settled_estimates_stay_and_the_least_is_taken(spark):
    """Two clusters: the start at the medians lies between them, and the tight one has the least determinant."""
    rand = np.random.default_rng(5)
    tight, wide = rand.normal(size=(600, 5)) * 0.02 + 1, rand.normal(size=(400, 5)) * 0.3 + 3
    x = np.concatenate([tight, wide])
    vectors = spark.createDataFrame([([""], row.tolist()) for row in x], "levels array<string>, x array<double>")
    (found,) = estimate(vectors, OutlierSettings()).collect()
    assert np.abs(np.array(found.centre) - 1).max() < 0.01


def test_odd_rows(spark):
    fine = " ".join(f"w{i % 7}x{i}" for i in range(40))
    long = " ".join(f"word{i}" for i in range(200_000))
    rows = [
        (1, None, None, None, 1, "a"),
        (2, "en", None, "", 2, "b"),
        (None, None, "s", fine, 3, "c"),
        (4, "en", "s", fine, 4, "d"),
        (4, "en", "s", fine, 4, "d"),
        (5, "en", "s", long, 5, "e"),
        (6, "en", "s", "same line here\n" * 30, 6, "f"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, stats long, level string")
    kept = keep_good(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "5", "None"]
    judged = {r.doc.doc_id: r for r in judge(df).collect()}
    assert judged[1].stats.n_words == 0 and judged[1].base_failed
    assert judged[6].base_failed and judged[6].stats.n_dup_lines == 29
    assert judged[5].stats.n_words == 200_000
    empty = df.limit(0)
    assert judge(empty).count() == 0 and keep_good(empty).columns == df.columns


def test_chi_square_quantiles():
    assert abs(chi2_quantile(0.95, 5) - 11.0705) < 1e-3
    assert abs(chi2_quantile(0.75, 5) - 6.6257) < 1e-3
    assert OutlierSettings().min_words == 20
