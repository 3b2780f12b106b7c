"""Mixing sources to target weights by entropy balancing. DataFrame operations only.

The mix takes document d at a rate r between 0 and ``most`` (copies per document, on average) such that the words
taken of every source meet its target, and deviates as little as it can from taking everything once: with
z = (size / mean size of the source) ^ tilt, it minimises the sum of size / z * (r log r - r + 1). Its dual has one
number per source, and the solution is an exponential tilt cut at the most allowed: r = min(most, exp(lambda * z)).
Newton steps find every lambda at once, kept inside brackets that each step narrows.

A step reads a histogram of sizes, not documents: rates depend on source and size only. Sums are exact decimals, so
they do not depend on the order of rows, and reruns agree to the last copy.

Rates become whole copies by systematic rounding over the sizes of a source from the largest down: with R the running
sum of rates, the documents of one size get the whole numbers that R passes on them. Each gets its rate rounded down,
and as many as that leaves, drawn by a hash of their id, one more. So the words taken differ from the target by about
one largest document of the source at most; the best of several beginnings is taken, and what is left made up for by
the documents of one size. Running sums go over the histogram, and documents of one source and size
are drawn in parts that do not grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import durable

WORD = r"[^\x20\x09-\x0D]+"
_SUM = "decimal(38,6)"
_MICRO = 1_000_000


@dataclass(frozen=True)
class MixSettings:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)  # of the sources in code-point order, repeating; null is the last
    most: int = 3  # times a document, and so a source, may be taken
    tilt: float = 0.25  # 0 takes all documents of a source at one rate
    steps: int = 60  # at most; each at least halves a bracket
    precise: float = 1e-7  # of the target, where a source's steps end
    starts: int = 16  # places tried for the beginning of a source's rounding
    cell_rows: int = 1000  # documents of one source and size that are ranked together, about
    broadcast_cells: int = 500_000  # cells sent to every task; beyond that they are joined by shuffling


def _weight(rank: Column, settings: MixSettings) -> Column:
    weights = F.array(*[F.lit(float(w)) for w in settings.weights])
    return F.element_at(weights, (F.pmod(rank - 1, F.lit(len(settings.weights))) + 1).cast("int"))


def targets(sizes: DataFrame, settings: MixSettings) -> DataFrame:
    """(source, source_size, target) from (source, source_size): all words shared by weight, no source above ``most``
    times its own, the excess shared by weight among the rest.

    The fair level per unit of weight is found in closed form: over the sources by what they hold per weight, the
    first at which what is left, shared among it and all after it, stays below what it holds. One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    known = sizes.withColumn("weight", _weight(F.row_number().over(order), settings)).withColumn(
        "top", settings.most * F.col("source_size").cast("double")
    )
    by_room = Window.orderBy(F.col("top") / F.col("weight"), "weight", "top")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = F.sum(F.col("source_size").cast("double")).over(Window.partitionBy())
    level = (everything - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = known.withColumn("level", level).withColumn(
        "fair", F.max(F.when(F.col("level") * F.col("weight") <= F.col("top"), F.col("level"))).over(Window.partitionBy())
    )
    # Levels fall from the first that fits on: beyond it they grant sources more than their share.
    return levels.select(
        "source", "source_size", F.least("top", F.coalesce(F.col("fair") * F.col("weight"), F.col("top"))).alias("target")
    )


def _rate(z: Column, dual: Column, settings: MixSettings) -> Column:
    return F.least(F.lit(float(settings.most)), F.exp(dual * z))


def _duals(cells: DataFrame, sources: DataFrame, settings: MixSettings) -> DataFrame:
    """(source_key, dual) from cells (source_key, size, n, z) and sources (source_key, source_size, target)."""
    reach = cells.where("size > 0").groupBy("source_key").agg(F.min("z").alias("z_least"))
    # At the upper end every document is taken as often as it may be; at the lower end, next to never.
    now = sources.join(reach, "source_key").select(
        "source_key",
        "target",
        (F.lit(-60.0) / F.col("z_least")).alias("low"),
        (F.log(F.lit(float(settings.most))) / F.col("z_least")).alias("high"),
        F.least(F.log(F.lit(float(settings.most))), F.log(F.col("target") / F.col("source_size"))).alias("dual"),
        (F.col("target") >= settings.most * F.col("source_size") * (1 - settings.precise)).alias("met"),
    )
    now = now.withColumn("dual", F.when(F.col("met"), F.col("high")).otherwise(F.col("dual")))
    now = durable(now, "mix-duals")
    for step in range(settings.steps):
        rated = cells.join(now, "source_key").withColumn("rate", _rate(F.col("z"), F.col("dual"), settings))
        words = F.col("n") * F.col("size") * F.col("rate")
        bends = F.when(F.col("rate") < settings.most, words * F.col("z")).otherwise(0.0)
        sums = rated.groupBy("source_key").agg(
            F.sum(words.cast(_SUM)).cast("double").alias("words"), F.sum(bends.cast(_SUM)).cast("double").alias("slope")
        )
        more = F.col("words") < F.col("target")
        bracket = now.join(sums, "source_key").select(
            "source_key",
            "target",
            F.when(more, F.col("dual")).otherwise(F.col("low")).alias("low"),
            F.when(more, F.col("high")).otherwise(F.col("dual")).alias("high"),
            "dual",
            (F.col("dual") + (F.col("target") - F.col("words")) / F.nullif(F.col("slope"), F.lit(0.0))).alias("newton"),
            (F.abs(F.col("words") - F.col("target")) <= settings.precise * F.col("target")).alias("near"),
            "met",
        )
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        step_to = F.when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        stuck = (F.col("high") - F.col("low")) <= 1e-12
        now = durable(
            bracket.select(
                "source_key",
                "target",
                "low",
                "high",
                F.when(F.col("near") | F.col("met"), F.col("dual")).otherwise(step_to).alias("dual"),
                (F.col("near") | F.col("met") | stuck).alias("met"),
            ),
            f"mix-duals-{step}",
        )
        if not now.where("not met").limit(1).count():
            break
    return now.select("source_key", "dual")


def _key(source: Column) -> Column:
    """The source as a join key; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def _evened(shares: DataFrame, settings: MixSettings) -> DataFrame:
    """The shares with ``more`` put right in one cell per source: the one whose documents, given or spared so many extra
    copies, make up best for what the source's words still differ from its target."""
    size, more = F.col("size"), F.col("more")
    totals = shares.groupBy("source_key", "target").agg(F.sum(size * (F.col("docs") * F.col("copies") + more)).alias("words"))
    missing = totals.select("source_key", (F.col("target") - F.col("words")).alias("missing"))
    room = F.when(F.col("copies") < settings.most, F.col("docs") - more).otherwise(F.lit(0))
    live = shares.where("size > 0 and rate > 0").join(missing, "source_key")
    step = F.greatest(-more, F.least(room, F.round(F.col("missing") / size).cast("long")))
    live = live.withColumn("step", step)
    left = F.struct(F.abs(F.col("missing") - F.col("step") * size).alias("left"), "size", "part", "step")
    chosen = live.groupBy("source_key").agg(F.min(left).alias("best")).select(
        "source_key", F.col("best.size").alias("size"), F.col("best.part").alias("part"), F.col("best.step").alias("step")
    )
    evened = shares.join(chosen, ["source_key", "size", "part"], "left")
    return durable(evened.withColumn("more", more + F.coalesce("step", F.lit(0))).drop("step"), "mix-evened")


def plan(thin: DataFrame, settings: MixSettings) -> DataFrame:
    """From (source, source_key, size, draw) of every document, one row per cell of source, size and part: the rate,
    the copies each document gets, and the draw up to which one gets one more."""
    per_source = thin.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
    goals = targets(per_source.select("source", "source_size"), settings)
    goals = durable(goals.withColumn("source_key", _key(F.col("source"))).drop("source"), "mix-targets")
    worded = F.when(F.col("size") > 0, F.col("size").cast("decimal(20,0)"))
    mean = thin.groupBy("source_key").agg(F.avg(worded).cast("double").alias("mean"))
    z = F.when(F.col("size") > 0, F.pow(F.col("size") / F.col("mean"), F.lit(settings.tilt))).otherwise(0.0)
    cells = thin.groupBy("source_key", "size").agg(F.count("*").alias("n")).join(mean, "source_key")
    cells = durable(cells.select("source_key", "size", "n", z.alias("z")), "mix-cells")
    duals = _duals(cells, goals.where("source_size > 0 and target > 0"), settings)

    # Rates in whole millionths, so that running sums are exact.
    dead = F.col("dual").isNull() | (F.col("size") == 0)
    rated = (
        cells.join(duals, "source_key", "left")
        .withColumn("rate", F.when(dead, F.lit(0.0)).otherwise(_rate(F.col("z"), F.col("dual"), settings)))
        .select(
            "source_key",
            "size",
            "rate",
            F.round(F.col("rate") * _MICRO).cast("long").alias("micro"),
            F.ceil(F.col("n") / settings.cell_rows).cast("long").alias("parts"),
        )
    )
    rated = durable(rated, "mix-rates")
    drawn = _celled(thin, rated.where("parts > 1").select("source_key", "size", "parts"), settings)
    counts = drawn.groupBy("source_key", "size", "part").agg(F.count("*").alias("docs"))
    down = Window.partitionBy("source_key").orderBy(F.desc("size"), "part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("docs") * F.col("micro")).over(down), F.lit(0))
    whole = lambda at: F.floor((F.col("start") + at) / _MICRO)
    summed = counts.join(rated, ["source_key", "size"]).withColumn("start", start)
    # Where the running sum begins is free: of some places, each source takes the one that meets its target best.
    places = [_MICRO * i // settings.starts for i in range(settings.starts)]
    passed = lambda at: whole(at + F.col("docs") * F.col("micro")) - whole(at)
    totals = summed.groupBy("source_key").agg(
        *[F.sum(F.col("size") * passed(F.lit(at))).alias(f"at_{at}") for at in places]
    )
    best = F.least(*[F.struct(F.abs(F.col(f"at_{at}") - F.col("target")), F.lit(at).alias("at")) for at in places])
    begins = goals.join(totals, "source_key").select("source_key", "source_size", "target", best["at"].alias("at"))
    shares = (
        summed.join(begins, "source_key")
        .withColumn("copies", F.floor(F.col("micro") / _MICRO).cast("int"))
        .withColumn("more", passed(F.col("at")) - F.col("docs") * F.col("copies"))
    )
    shares = durable(shares.drop("at", "start", "micro"), "mix-shares")
    shares = _split(_evened(shares, settings), drawn)
    cell = ["source_key", "size", "part", "sub"]
    chosen = drawn.join(shares.where("more > 0").select(*cell, "more"), cell)
    at = F.struct("draw", "row")
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy(at))
    last = chosen.withColumn("rank", rank).where("rank = more").select(*cell, at.alias("last"))
    return durable(shares.drop("docs", "more").join(last, cell, "left"), "mix-plan")


def _celled(rows: DataFrame, crowded: DataFrame, settings: MixSettings) -> DataFrame:
    """Rows with the ``part`` of their source and size that they are drawn in, and a ``sub`` of it.

    A crowded size, one of more than ``cell_rows`` documents, is cut by the draws. Equal documents have equal draws:
    where these alone are more than that, they are a part of their own, cut into subs by row. Which of them gets
    a copy more makes no difference.
    """
    key = ["source_key", "size"]
    many = rows.join(_sent(crowded, settings), key).groupBy(*key, "draw").agg(F.count("*").alias("n"))
    many = many.where(F.col("n") > settings.cell_rows)
    twins = durable(many.select(*key, "draw", F.ceil(F.col("n") / settings.cell_rows).cast("long").alias("subs")), "mix-twins")
    joined = rows.join(_sent(crowded, settings), key, "left").join(_sent(twins, settings), [*key, "draw"], "left")
    own = F.col("subs").isNotNull()
    part = F.when(own, -1 - F.shiftrightunsigned("draw", 1)).otherwise(F.pmod("draw", F.coalesce("parts", F.lit(1).cast("long"))))
    sub = F.when(own, F.pmod("row", "subs")).otherwise(F.lit(0).cast("long"))
    return joined.withColumns({"part": part, "sub": sub}).drop("parts", "subs")


def _sent(small: DataFrame, settings: MixSettings) -> DataFrame:
    """A table by cells, marked for sending to all tasks if it is small enough."""
    return F.broadcast(small) if small.limit(settings.broadcast_cells + 1).count() <= settings.broadcast_cells else small


def _split(shares: DataFrame, drawn: DataFrame) -> DataFrame:
    """The shares by sub: those of a part of equal documents get of its ``more`` in proportion to their rows."""
    key = ["source_key", "size", "part"]
    subs = drawn.where("part < 0").groupBy(*key, "sub").agg(F.count("*").alias("n"))
    up = Window.partitionBy(*key).orderBy("sub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    subs = subs.withColumn("up_to", F.sum("n").over(up))
    passed = lambda at: F.floor(at.cast("decimal(19,0)") * F.col("more") / F.col("docs"))
    more = passed(F.col("up_to")) - passed(F.col("up_to") - F.col("n"))
    equal = shares.where("part < 0").join(subs, key).withColumn("more", more.cast("long")).drop("n", "up_to")
    return durable(shares.where("part >= 0").withColumn("sub", F.lit(0).cast("long")).unionByName(equal), "mix-subs")


def mix(
    docs: DataFrame,
    settings: MixSettings = MixSettings(),
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (its columns ``keep``, by default all), ``size`` in words, ``source_size``,
    ``target`` of its source, ``rate``, ``copies`` and ``taken`` = copies * size.

    Null and blank texts have size 0, rate 0 and no copies. Null is a source, and so is a source without words, which
    has target 0. Documents of one size are told apart by their id and text; equal ones, or all with a null id and the
    same text, count one by one, and as many of them as their rate says get a copy more. Other columns, whatever their
    names, do not matter; an empty table gives no rows.
    """
    kept = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[docs[c] for c in kept]).alias("doc"),
        F.xxhash64(docs[id].cast("string"), docs[text].cast("string")).alias("draw"),
        F.monotonically_increasing_id().alias("row"),
        docs[source].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs[text].cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("source_key", _key(F.col("source")))
    rows = durable(rows, "mix-rows")  # a row's number must stay what it is
    cells = plan(rows.drop("doc"), settings)
    crowded = cells.where("parts > 1").select("source_key", "size", "parts").distinct()
    joined = _celled(rows, crowded, settings)
    joined = joined.join(_sent(cells.drop("parts"), settings), ["source_key", "size", "part", "sub"])
    copies = F.col("copies") + F.coalesce(F.struct("draw", "row") <= F.col("last"), F.lit(False)).cast("int")
    return joined.withColumn("copies", copies).select(
        "doc", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def remixed(docs: DataFrame, settings: MixSettings = MixSettings(), **names: str) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = mix(docs, settings, **names).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
