"""Benchmark decontamination by SimHash of item-sized windows. DataFrame operations only.

A window is a stretch of a document with as many words as a benchmark item. What a window shares with an item weighs no
more than those of its places that hold a shingle of the item, wherever the item has it. Sums of these over the places
of a text give every start from which a window can reach the similarity, and only those windows are laid, whatever
the order of the item's parts in them. Each window and item gets a 64-bit SimHash of its weighted shingles. Cut into
``radius + 1`` blocks, two fingerprints within the radius agree in one block at least: windows meet the items of
their length on equal blocks, pairs beyond the radius go, and the weighted Jaccard similarity of the rest is computed
exactly from the shingles themselves.

Documents are told apart by their text, so copies are examined once and rows need no id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import durable

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "\t\n\x0b\f\r "
_BITS = 64
_TEXT = ["text_hash", "text_length"]


@dataclass(frozen=True)
class LeakSettings:
    words: int = 5  # of a shingle
    similarity: float = 0.8
    # Bits in which the fingerprints of like texts may differ. At similarity 0.8 they differ in 10 of 64 on average,
    # with a deviation of 3; so 20 misses one in thousands there, and none to speak of above.
    radius: int = 20
    broadcast_rows: int = 1_000_000  # shingles of items, or texts with windows, sent to every task; else shuffled
    listed_rows: int = 100_000  # shingles of items of which one word each is looked for first; beyond, all are hashed


def _lowered(text: Column) -> Column:
    """ASCII letters lowered. Texts of ASCII alone take the plain function, which is much the faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _split(text: Column) -> Column:
    """The words of a text as they stand; null for a text without any."""
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _words(text: Column) -> Column:
    """The words of a text with ASCII letters lowered; null for a text without any."""
    return _split(_lowered(text))


def _runs(words: str, n: Column) -> Column:
    """Every run of ``n`` words, as one string each."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))


def _hash(words: str, place: Column, n: int) -> Column:
    """A hash of the ``n`` words from ``place`` on, lowered, without putting the run together."""
    return F.xxhash64(*[_lowered(F.col(words)[place + k]) for k in range(n)])


def _small(df: DataFrame, settings: LeakSettings) -> DataFrame:
    """``df`` to be sent to all tasks if it is below the bound; it must be a written table, for it is counted."""
    return F.broadcast(df) if df.count() <= settings.broadcast_rows else df


def _weighed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, run, weight): the distinct shingles, weighing their length times how often they occur."""
    return rows.groupBy(*keys, "run").agg((F.count("*") * F.length("run")).alias("weight"))


def _fingerprints(weighed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, total weight, SimHash): a bit is set if the shingles whose hash has it weigh more than the others."""
    bits = F.explode(F.sequence(F.lit(0), F.lit(_BITS - 1))).alias("bit")
    votes = weighed.select(*keys, "weight", F.xxhash64("run").alias("hash"), bits)
    summed = votes.groupBy(*keys, "bit").agg(
        F.sum("weight").alias("total"), F.sum(F.expr("if(getbit(hash, bit) = 1, weight, -weight)")).alias("vote")
    )
    return summed.groupBy(*keys).agg(
        F.max("total").alias("total"), F.expr("bit_or(if(vote > 0, shiftleft(1L, bit), 0L))").alias("print")
    )


def _blocks(fingerprint: str, radius: int) -> Column:
    """The blocks of a fingerprint with their numbers, as an array to explode."""
    edges = [_BITS * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value"),
            )
            for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True))
        ]
    )


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """(text, words) of the texts with words, which are as they stand."""
    body = docs[text].cast("string")
    return docs.select(
        F.xxhash64(body).alias("text_hash"), F.length(body).alias("text_length"), _split(body).alias("words")
    ).where("words is not null")


def _key_word(run: Column, n: Column) -> Column:
    """The word by which a shingle is looked for, and its place in it: the longest word, the first in order of several,
    as long words are rare ones."""
    words = F.transform(F.sequence(F.lit(0), n - 1), lambda at: F.struct(-F.length(run[at]), run[at].alias("word"), at.alias("at")))
    return F.array_min(words)


def _numbers(hashes: DataFrame) -> list[int]:
    return [r[0] for r in hashes.distinct().collect()]


def _placed_runs(texts: DataFrame, own: DataFrame, n: int, settings: LeakSettings) -> DataFrame:
    """(text, size, place, hash) of the runs of ``n`` words that may be a shingle of an item (``own``), all of those
    among them.

    A run can only be one if the word that the shingle is looked for by stands in it, at its place. Most words are none
    of those, and the runs around them need not be hashed. Words become rows by generators rather than lambda functions,
    so that splitting, looking and hashing compile into one loop; the rows that a word drops are never laid out.
    """
    texts = texts.where(F.size("words") >= n).select(*_TEXT, F.size("words").alias("size"), "words")
    if own.count() > settings.listed_rows:
        starts = texts.select("*", F.explode(F.sequence(F.lit(0), F.col("size") - n)).alias("place"))
        return starts.select(*_TEXT, "size", "place", _hash("words", F.col("place"), n).alias("hash"))
    keys = own.select("key.word", "key.at").distinct()
    spots = texts.select("*", F.posexplode("words").alias("spot", "raw")).withColumn("word", _lowered(F.col("raw")))
    spots = spots.where(F.xxhash64("word").isin(_numbers(keys.select(F.xxhash64("word")))))
    offsets = F.array(*[F.lit(k) for k in range(n)])
    runs = (
        spots.select("*", F.explode(offsets).alias("at"))
        .where(F.xxhash64("word", "at").isin(_numbers(keys.select(F.xxhash64("word", "at")))))
        .withColumn("place", F.col("spot") - F.col("at"))
        .where((F.col("place") >= 0) & (F.col("place") <= F.col("size") - n))
    )
    return runs.select(*_TEXT, "size", "place", _hash("words", F.col("place"), n).alias("hash"))


def _starts(found: DataFrame, settings: LeakSettings) -> DataFrame:
    """(text, n, n_words, start, room) of all windows that can be like an item, from the places that hold one of its
    shingles (text, size, place, item, weight, needed). A window that weighs more than ``room`` cannot."""
    keys = [*_TEXT, "size", "item_id", "n_words", "n", "needed"]
    hits = durable(found.groupBy(*keys, "place").agg(F.max("weight").alias("weight")), "leak-hits")
    # A window has n_words - n + 1 places. Places in units of that, less a half, so one frame fits items of all lengths.
    reach = F.col("n_words") - F.col("n")
    item = Window.partitionBy(*keys).orderBy("unit")
    ahead = F.sum("weight").over(item.rangeBetween(0, 1))
    with_unit = lambda df: df.withColumn("unit", F.col("place") / (reach + F.lit(0.5)))
    # The windows whose first hit is this place, and which have enough ahead of it.
    firsts = (
        with_unit(hits)
        .select(*keys, "place", ahead.alias("ahead"), F.lag("place").over(item).alias("last"))
        .where(F.col("ahead") >= F.col("needed") * (1 - 1e-9))
    )
    lowest = F.greatest(F.col("last") + 1, F.col("place") - reach)
    starts = durable(firsts.select(*keys, F.explode(F.sequence(lowest, F.col("place"))).alias("place")), "leak-starts")
    # Windows that begin before the text and end behind it have the same words as the next.
    starts = starts.where((F.col("place") >= 0) | (F.col("place") + F.col("n_words") <= F.col("size")))
    held = hits.join(starts.select(*keys).distinct(), keys, "left_semi")
    both = held.withColumn("start", F.lit(False)).unionByName(
        starts.withColumns({"weight": F.lit(0), "start": F.lit(True)})
    )
    summed = with_unit(both).select(*keys, "place", "start", ahead.alias("hit")).where("start")
    room = F.col("hit") + (F.col("hit") - F.col("needed")) / settings.similarity
    enough = summed.where(F.col("hit") >= F.col("needed") * (1 - 1e-9))
    return enough.groupBy(*_TEXT, "n", "n_words", F.col("place").alias("start")).agg((F.max(room) * (1 + 1e-9)).alias("room"))


def matches(docs: DataFrame, items: DataFrame, settings: LeakSettings, text: str, item: str, item_text: str) -> DataFrame:
    """(text_hash, text_length, item_id, start_word, n_words, distance, similarity) of every window like an item."""
    listed = durable(
        items.select(items[item].alias("item_id"), _words(items[item_text].cast("string")).alias("words"))
        .where("words is not null")
        .select("item_id", F.size("words").alias("n_words"), F.least(F.size("words"), F.lit(settings.words)).alias("n"), "words"),
        "leak-items",
    )
    item_keys = ["item_id", "n_words", "n"]
    item_runs = durable(listed.select(*item_keys, F.posexplode(_runs("words", F.col("n"))).alias("at", "run")), "leak-item-runs")
    pieces = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1), lambda i: F.slice("words", i, F.col("n")))
    placed = listed.select(*item_keys, F.explode(pieces).alias("run")).select(
        *item_keys,
        "run",
        F.length(F.array_join("run", " ")).alias("weight"),
        _key_word(F.col("run"), F.col("n")).alias("key"),
    )
    own_weights = placed.groupBy(*item_keys).agg((F.sum("weight") * settings.similarity).alias("needed"))
    anchors = durable(placed.distinct().join(own_weights, item_keys), "leak-anchors")

    # Shingles have as many words as the shortest items allow: five but for items with fewer.
    sizes = sorted(r.n for r in listed.select("n").distinct().collect())  # at most five numbers
    texts = _keyed(docs, text)
    few = anchors.count() <= settings.broadcast_rows
    found = None
    for n in sizes:
        own = anchors.where(F.col("n") == n).withColumn("hash", _hash("run", F.lit(0), n)).drop("run")
        runs = _placed_runs(texts, own, n, settings)
        own = own.drop("key")
        one = runs.join(F.broadcast(own) if few else own, "hash").drop("hash")
        found = one if found is None else found.unionByName(one)
    windows = _starts(found, settings) if found is not None else anchors.sparkSession.createDataFrame(
        [], "text_hash long, text_length int, n int, n_words int, start int, room double"
    )
    windows = durable(windows, "leak-windows")

    # The texts that have windows, once each, and the shingles of their windows.
    holders = durable(windows.select(*_TEXT).distinct(), "leak-texts")
    held = texts.join(_small(holders, settings), _TEXT, "left_semi").dropDuplicates(_TEXT)
    held = durable(held.withColumn("words", F.transform("words", _lowered)), "leak-words")
    window_keys = [*_TEXT, "n", "n_words", "start"]
    cut = F.slice("words", F.greatest("start", F.lit(0)) + 1, F.col("n_words") + F.least("start", F.lit(0)))
    pieces = held.join(windows, _TEXT).select(*window_keys, "room", cut.alias("piece")).where(F.size("piece") >= F.col("n"))
    pieces = pieces.select(*window_keys, "room", _runs("piece", F.col("n")).alias("runs"))
    weight = F.aggregate("runs", F.lit(0), lambda total, run: total + F.length(run))
    window_runs = durable(
        _weighed(pieces.where(weight <= F.col("room")).select(*window_keys, F.explode("runs").alias("run")), window_keys),
        "leak-window-runs",
    )
    item_weights = durable(_weighed(item_runs, item_keys), "leak-item-weights")

    window_prints = _fingerprints(window_runs, window_keys).select(
        *window_keys, "total", "print", F.explode(_blocks("print", settings.radius)).alias("b")
    )
    item_prints = _fingerprints(item_weights, item_keys).select(
        *item_keys, F.col("total").alias("item_total"), F.col("print").alias("item_print"), F.explode(_blocks("print", settings.radius)).alias("b")
    )
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = (
        window_prints.join(item_prints, ["n", "n_words", "b"])
        .withColumn("distance", distance)
        .where(F.col("distance") <= settings.radius)
        .drop("b", "print", "item_print")
        .distinct()
    )
    near = durable(near, "leak-candidates")

    common = (
        near.join(window_runs, window_keys)
        .join(item_weights.withColumnRenamed("weight", "item_weight"), [*item_keys, "run"])
        .groupBy(*window_keys, "item_id", "distance", "total", "item_total")
        .agg(F.sum(F.least("weight", "item_weight")).alias("common"))
    )
    similarity = F.col("common") / (F.col("total") + F.col("item_total") - F.col("common"))
    return common.withColumn("similarity", similarity).where(F.col("similarity") >= settings.similarity).select(
        *_TEXT, "item_id", F.col("start").alias("start_word"), "n_words", "distance", "similarity"
    )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    settings: LeakSettings = LeakSettings(),
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, distance, similarity): for each row of ``docs`` and item it holds, the
    window most like the item, the first of equals. ``start_word`` counts words from 0 and may be negative or run past
    the end where a text has only part of an item.

    Null and blank texts hold nothing, null and blank items are held by nothing. Items of fewer than five words match
    windows with the same words. Rows with equal text have equal results, whatever their ids; items with equal text
    are reported each. Other columns do not matter; empty tables give no rows.
    """
    found = matches(docs, items, settings, text, item, item_text)
    order = F.struct("similarity", -F.col("start_word"))
    best = found.groupBy(*_TEXT, "item_id").agg(
        F.max_by(F.struct("start_word", "n_words", "distance", "similarity"), order).alias("best")
    )
    body = docs[text].cast("string")
    rows = docs.select(docs[id].alias("doc_id"), F.xxhash64(body).alias("text_hash"), F.length(body).alias("text_length"))
    return rows.join(_small(durable(best, "leaks"), settings), _TEXT).select("doc_id", "item_id", "best.*")


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    settings: LeakSettings = LeakSettings(),
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with its columns."""
    found = durable(matches(docs, items, settings, text, item, item_text).select(*_TEXT).distinct(), "leaking-texts")
    body = docs[text].cast("string")
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.xxhash64(body).alias("text_hash"), F.length(body).alias("text_length"))
    return marked.join(_small(found, settings), _TEXT, "left_anti").select("doc.*")
