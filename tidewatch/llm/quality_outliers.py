"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Every whole text gives a vector of transformed statistics. Per group, the share of the rows whose covariance has the
least determinant is searched from three fixed starts by concentration steps: distances to the last estimate, the
closest share of the rows, their mean and covariance. Each start goes on until its determinant falls no more, and the
least of the three is taken. Its centre and spread are then fitted once more, to all rows within a usual distance.
Rows whose squared Mahalanobis distance is beyond a chi-square quantile are rejected. ``floors`` are added to each
spread (before determinants are compared, so that the steps still only lower them): constant statistics stay regular.

A group's rows never meet in one task. Shares are cut by histograms of the distance, means and covariances are sums,
so each step moves a few numbers per group and task. Groups below ``min_group`` rows take the estimate of their
language, and that of all rows where the language is too small as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.docstats import COUNTS, count
from tidewatch.llm.textbytes import texts
from tidewatch.session import durable

FEATURES = ("symbols", "upper", "punctuation", "dup_lines", "word_length")


@dataclass(frozen=True)
class OutlierSettings:
    min_words: int = 20
    max_repeat_percent: int = 30  # of the words, inside repeated windows
    share: float = 0.55  # of a group's rows whose determinant is made least; up to the rest may be junk
    steps: int = 50  # at most; starts settle after two to eight
    fall: float = 1e-3  # of the log determinant, below which a start has settled
    usual: float = 0.975  # of a normal group's rows, in the last fit
    tail: float = 1e-3  # of rows of a normal group that would be rejected
    min_group: int = 200
    min_rows: int = 30  # with fewer rows in all there is nothing to be an outlier of
    broadcast_levels: int = 100_000  # estimates sent to every task; beyond that rows meet them by level and salt
    salts: int = 256
    # Spread that a clean group has anyway, in units of the transformed statistics: 0.02 is a share of 1 in 2,500,
    # 0.12 one of 1.4 % of the lines, and 2 % of the mean word length.
    floors: tuple[float, ...] = (0.02, 0.015, 0.015, 0.12, 0.02)


def _chi2_cdf(x: float, p: int) -> float:
    """The regularised incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    a, x = p / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_cdf(middle, p) < q else (low, middle)
    return high


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The vectors: arcsine of the root of four shares, and the log of the mean word length."""
    chars, words = np.maximum(counts["word_chars"], 1), np.maximum(counts["n_words"], 1)
    share = lambda part, whole: np.arcsin(np.sqrt(np.clip(part / whole, 0, 1)))
    return np.stack(
        [
            share(counts["n_symbols"], chars),
            share(counts["n_upper"], chars),
            share(counts["n_punctuation"], chars),
            share(counts["n_dup_lines"], np.maximum(counts["n_lines"], 1)),
            np.log(chars / words),
        ],
        axis=1,
    )


_STATS = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS] + [T.StructField("x", T.ArrayType(T.DoubleType()))])


def with_stats(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc`` (the row as a struct, or only its columns ``keep``) and ``stats`` (counts and the vector ``x``)."""
    named = docs.select(
        F.struct(*[docs[c] for c in (docs.columns if keep is None else keep)]).alias("doc"),
        docs[text].cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts(batch.column(1)):
                counts = count(part)
                x = features(counts)
                lists = pa.ListArray.from_arrays(
                    np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())
                )
                stats = pa.StructArray.from_arrays([pa.array(counts[n]) for n in COUNTS] + [lists], [*COUNTS, "x"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.rows), stats], ["doc", "stats"]
                )

    schema = T.StructType([T.StructField("doc", named.schema["doc"].dataType), T.StructField("stats", _STATS)])
    return named.mapInArrow(run, schema)


def base_failed(settings: OutlierSettings, stats: str = "stats") -> Column:
    words = F.col(f"{stats}.n_words")
    return (words < settings.min_words) | (
        100 * F.col(f"{stats}.n_repeat_words") > settings.max_repeat_percent * words
    )


def _levels(lang: Column, source: Column) -> Column:
    """Keys from the finest group to all rows. Null is a value of its own."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    return F.array(F.concat_ws("\t", part(lang), part(source)), part(lang), F.lit(""))


def _distance(x: str, centre: str, inverse: str) -> Column:
    p = len(FEATURES)
    off = [F.col(x)[i] - F.col(centre)[i] for i in range(p)]
    terms = [
        off[i] * off[j] * F.col(inverse)[i * p + j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _meet(rows: DataFrame, small: DataFrame, keys: list[str], few: bool, settings: OutlierSettings) -> DataFrame:
    """``rows`` joined with a few rows per level, left. One level may hold all rows: the other side is sent to every task,
    or, if there are too many levels for that, each level's rows are spread by a salt."""
    if few:
        return rows.join(F.broadcast(small), keys, "left")
    # The rows come from files in the task that salts them, so a task that is run again gives them the same salts.
    salts = F.sequence(F.lit(0), F.lit(settings.salts - 1))
    spread = rows.withColumn("salt", F.floor(F.rand(1) * settings.salts).cast("int"))
    return spread.join(small.withColumn("salt", F.explode(salts)), [*keys, "salt"], "left").drop("salt")


_NUMBERS = T.ArrayType(T.DoubleType())
_ESTIMATE = T.StructType(
    [
        T.StructField("level", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("centre", _NUMBERS),
        T.StructField("inverse", _NUMBERS),
        T.StructField("det", T.DoubleType()),  # its logarithm
        T.StructField("falling", T.BooleanType()),
    ]
)
_RESOLUTION = 1024  # bins of one unit of a statistic, for the starts
_P = len(FEATURES)


def _sums() -> list[Column]:
    return [
        F.count("*").alias("members"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(_P)]).alias("firsts"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(_P) for j in range(i, _P)]).alias("seconds"),
    ]


def _covariance(members: int, firsts: np.ndarray, seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from a count, sums and the upper triangle of sums of products."""
    centre = np.asarray(firsts) / members
    upper = np.zeros((_P, _P))
    upper[np.triu_indices(_P)] = np.asarray(seconds) / members
    return centre, upper + np.triu(upper, 1).T - np.outer(centre, centre)


def _quantiles(bins: np.ndarray, counts: np.ndarray) -> list[float]:
    """Median and quartile width, middle and width of the shortest half, from a histogram in order."""
    below = np.cumsum(counts)
    low, middle, high = (float(bins[np.searchsorted(below, q * below[-1])]) for q in (0.25, 0.5, 0.75))
    ends = np.searchsorted(below, below - counts + 0.5 * below[-1])
    firsts = np.flatnonzero(ends < len(bins))
    widths = bins[ends[firsts]] - bins[firsts]
    k = int(widths.argmin())
    half = (float(bins[firsts[k]]) + widths[k] / 2, float(widths[k]))
    return [v / _RESOLUTION for v in (middle, (high - low) / 1.349, half[0], half[1] / 1.349)]


def _scales(rows: DataFrame) -> DataFrame:
    """(level, n, m0, w0, m1, w1): per level and statistic the two pairs of centre and width that starts are made of.
    A statistic has some 20,000 bins at most, whatever the number of rows."""
    bins = (
        rows.select("level", F.posexplode("x").alias("i", "value"))
        .groupBy("level", "i", F.floor(F.col("value") * _RESOLUTION).cast("long").alias("bin"))
        .agg(F.count("*").alias("rows_in_bin"))
        .groupBy("level", "i")
        .agg(F.sort_array(F.collect_list(F.struct("bin", "rows_in_bin"))).alias("bins"), F.sum("rows_in_bin").alias("n"))
        .select("level", "i", "n", F.col("bins.bin").alias("bins"), F.col("bins.rows_in_bin").alias("counts"))
    )

    def run(frames):
        for frame in frames:
            found = [
                (r.level, r.i, r.n, *_quantiles(np.asarray(r.bins), np.asarray(r.counts))) for r in frame.itertuples()
            ]
            yield pd.DataFrame(found, columns=["level", "i", "n", "m0", "w0", "m1", "w1"])

    each = bins.mapInPandas(run, "level string, i int, n long, m0 double, w0 double, m1 double, w1 double")
    parts = each.groupBy("level").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "m0", "w0", "m1", "w1"))).alias("parts")
    )
    return parts.select("level", "n", *[F.col(f"parts.{c}").alias(c) for c in ("m0", "w0", "m1", "w1")])


def _starts(rows: DataFrame, few: bool, settings: OutlierSettings) -> DataFrame:
    """Three estimates per level: medians and quartile widths, shortest halves, and the covariance of the statistics
    drawn in by a hyperbolic tangent around the medians."""
    scales = durable(_scales(rows), "mcd-scales")
    floors = np.array(settings.floors)
    near = _meet(rows, scales.select("level", "m0", "w0"), ["level"], few, settings)
    wide = [F.sqrt(F.col("w0")[i] * F.col("w0")[i] + settings.floors[i] ** 2) for i in range(_P)]
    drawn = near.select(
        "level", F.array(*[F.tanh((F.col("x")[i] - F.col("m0")[i]) / wide[i]) for i in range(_P)]).alias("x")
    )

    def run(frames):
        for frame in frames:
            found = []
            for r in frame.itertuples():
                m0, w0, m1, w1 = (np.asarray(v) for v in (r.m0, r.w0, r.m1, r.w1))
                wide = np.sqrt(w0 * w0 + floors * floors)
                _, drawn = _covariance(r.members, r.firsts, r.seconds)
                spreads = (
                    np.diag(wide * wide),
                    np.diag(w1 * w1 + floors * floors),
                    np.outer(wide, wide) * (drawn + 0.05 * np.eye(_P)),
                )
                for start, (centre, spread) in enumerate(zip((m0, m1, m0), spreads)):
                    inverse = np.linalg.inv(spread).ravel().tolist()
                    found.append((r.level, r.n, start, centre.tolist(), inverse, math.inf, True))
            yield pd.DataFrame(found, columns=_ESTIMATE.names)

    return scales.join(drawn.groupBy("level").agg(*_sums()), "level").mapInPandas(run, _ESTIMATE)


def _refitted(now: DataFrame, sums: DataFrame, floors: tuple[float, ...], scale: float, fall: float) -> DataFrame:
    """Estimates from the sums over their closest rows. One whose determinant falls no more stays as it was."""

    def run(frames):
        for frame in frames:
            found = []
            for r in frame.itertuples():
                row = (r.level, r.n, r.start, list(r.centre), list(r.inverse), r.det, False)
                if r.falling and r.firsts is not None:
                    centre, spread = _covariance(r.members, r.firsts, r.seconds)
                    spread = scale * spread + np.diag(np.square(floors))
                    det = float(np.linalg.slogdet(spread)[1])
                    if det < r.det - fall:
                        inverse = np.linalg.inv(spread).ravel().tolist()
                        row = (r.level, r.n, r.start, centre.tolist(), inverse, det, True)
                found.append(row)
            yield pd.DataFrame(found, columns=_ESTIMATE.names)

    return now.join(sums, ["level", "start"], "left").mapInPandas(run, _ESTIMATE)


def _concentrated(rows: DataFrame, now: DataFrame, few: bool, settings: OutlierSettings) -> DataFrame:
    """One step of each estimate that still falls."""
    falling = now.where("falling").select("level", "start", "n", "centre", "inverse")
    bin = F.floor(F.log2(1 + _distance("x", "centre", "inverse")) * 256).cast("long")
    bins = (
        _meet(rows, falling, ["level"], few, settings)
        .where("start is not null")
        .groupBy("level", "start", bin.alias("bin"))
        .agg(F.count("*").alias("rows_in_bin"))
    )
    # Bins of the distance, some thousands at most per estimate.
    below = Window.partitionBy("level", "start").orderBy("bin")
    cuts = (
        bins.withColumn("below", F.sum("rows_in_bin").over(below))
        .join(falling.select("level", "start", "n"), ["level", "start"])
        .where(F.col("below") >= settings.share * F.col("n"))
        .groupBy("level", "start")
        .agg(F.min("bin").alias("cut"))
    )
    # Rows are read again rather than carried along: they come from files, and a task run again sees the same.
    closest = _meet(rows, falling.join(cuts, ["level", "start"]), ["level"], few, settings).where(bin <= F.col("cut"))
    cut = chi2_quantile(settings.share, _P)
    scale = settings.share / _chi2_cdf(cut, _P + 2)  # the covariance of the closest share, made that of all
    return _refitted(now, closest.groupBy("level", "start").agg(*_sums()), settings.floors, scale, settings.fall)


def estimate(vectors: DataFrame, settings: OutlierSettings) -> DataFrame:
    """Centre and inverse covariance per level, from rows (levels, x). Each step is written, so it runs once."""
    spread_rows = vectors.select(F.explode("levels").alias("level"), "x")
    sizes = spread_rows.groupBy("level").agg(F.count("*").alias("n"))
    # The level "" always has an estimate: the others fall back on it.
    wanted = durable(sizes.where((F.col("n") >= settings.min_group) | (F.col("level") == "")), "mcd-levels")
    few = wanted.count() <= settings.broadcast_levels
    known = wanted.select("level", F.lit(True).alias("wanted"))
    rows = _meet(spread_rows, known, ["level"], few, settings).where("wanted").drop("wanted")
    rows = durable(rows, "mcd-rows")

    now = durable(_starts(rows, few, settings), "mcd-starts")
    for step in range(settings.steps):
        now = durable(_concentrated(rows, now, few, settings), f"mcd-step-{step}")
        if not now.where("falling").take(1):
            break

    least = now.groupBy("level").agg(F.min_by(F.struct(*_ESTIMATE.names), F.struct("det", "start")).alias("best"))
    # The last fit is taken whatever its determinant: it stands on more rows.
    best = durable(
        least.select("best.*").withColumns({"det": F.lit(math.inf), "falling": F.lit(True)}), "mcd-least"
    )
    limit = chi2_quantile(settings.usual, _P)
    near = _meet(rows, best.select("level", "start", "centre", "inverse"), ["level"], few, settings)
    usual = near.where(_distance("x", "centre", "inverse") <= limit).groupBy("level", "start").agg(*_sums())
    scale = settings.usual / _chi2_cdf(limit, _P + 2)
    return durable(_refitted(best, usual, settings.floors, scale, 0.0), "mcd-fit")


def _judged(rows: DataFrame, estimates: DataFrame, settings: OutlierSettings) -> DataFrame:
    """Rows (doc, stats, levels) with ``distance`` and ``kept``; the finest level with an estimate decides."""
    few = estimates.count() <= settings.broadcast_levels
    finest, estimates = rows, estimates.where(F.col("n") >= settings.min_rows)
    for k in range(3):
        one = estimates.select(F.col("level").alias(f"level_{k}"), F.struct("centre", "inverse").alias(f"estimate_{k}"))
        finest = _meet(finest.withColumn(f"level_{k}", F.col("levels")[k]), one, [f"level_{k}"], few, settings).drop(f"level_{k}")
    finest = finest.withColumn("estimate", F.coalesce("estimate_0", "estimate_1", "estimate_2"))
    limit = chi2_quantile(1 - settings.tail, len(FEATURES))
    failed = base_failed(settings)
    distance = F.when(~failed, _distance("stats.x", "estimate.centre", "estimate.inverse"))
    return finest.select(
        "doc",
        "stats",
        failed.alias("base_failed"),
        distance.alias("distance"),
        (~failed & F.coalesce(distance <= limit, F.lit(True))).alias("kept"),
    )


def _with_levels(rows: DataFrame, lang: str, source: str) -> DataFrame:
    return rows.withColumn("levels", _levels(F.col("doc")[lang].cast("string"), F.col("doc")[source].cast("string")))


def judge(
    docs: DataFrame,
    settings: OutlierSettings = OutlierSettings(),
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (its columns ``keep``, by default all but the text), ``stats``,
    ``base_failed``, ``distance`` (null where the base rules fail) and ``kept``.

    Null text counts as empty and fails the base rules; null language or source is a group of its own; repeated rows
    are judged alike; an empty table gives no rows, and with fewer than ``min_rows`` no row is an outlier. Other columns, whatever their names, do not matter.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    needed = list(dict.fromkeys([*keep, lang, source]))
    stats = durable(with_stats(docs, text, needed), "doc-stats")
    rows = _with_levels(stats, lang, source)
    vectors = rows.where(~base_failed(settings)).select("levels", F.col("stats.x").alias("x"))
    return _judged(rows, estimate(vectors, settings), settings)


def keep_good(
    docs: DataFrame,
    settings: OutlierSettings = OutlierSettings(),
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that pass, with its columns. Texts are read a second time rather than carried through
    the estimation, so rows need no key."""
    stats = durable(with_stats(docs, text, [lang, source]), "doc-stats")
    rows = _with_levels(stats, lang, source)
    vectors = rows.where(~base_failed(settings)).select("levels", F.col("stats.x").alias("x"))
    estimates = estimate(vectors, settings)
    whole = _with_levels(with_stats(docs, text), lang, source)
    return _judged(whole, estimates, settings).where("kept").select("doc.*")
