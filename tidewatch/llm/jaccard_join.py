"""Set-similarity join of documents on word shingles, by partitioning the universe of shingles.

Two sets link when the Jaccard similarity of their shingles reaches a threshold, so they differ in few shingles: in
at most H for all pairs whose smaller set falls in one band of sizes. Each band splits the universe into segments by
a hash. By the pigeonhole principle two linked sets have more equal segments than a set may leave out:

* every set is indexed under its subset in each segment of its band, and of the band below if a smaller partner can
  be there;
* on some segments it is indexed under all subsets with one element less too, which finds partners that differ by
  one there; such a segment counts twice against H, unless only one element is in it;
* how many segments of either kind a band has is decided by their cost in rows, such that its sets can leave out
  their empty segments and some more; a set leaves out those it shares with most others. It is still found there by
  sets that use them. The rare set with more empty segments than it can leave out is put next to every set of its
  band, which is spread over many buckets for that.

Sets sharing a used segment are compared: first each with the first set of its bucket only; then, among the components
that gave, all that are still apart, from the larger set's side. So a group of near copies costs a few comparisons per
member, and no link between different components is lost. Comparing starts with the parity of each set's elements in
``PARITY`` bits: a pair differs in at least as many elements as its parities in bits, which rules most pairs out at
once and no link; what is left is compared shingle by shingle.

Sets are held as 64-bit shingle hashes: comparisons are exact up to collisions inside a pair of texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.components import components
from tidewatch.llm.textbytes import LOWER, Texts, grams, mix, span_hashes, texts
from tidewatch.session import durable

_STEP = np.uint64(0xD6E8FEB86659FD93)

# What a signature stands for. In the band below its own, where a set can only be the larger partner, it is 4 more.
EXACT, LOOSE, DELETION, WHOLE = range(4)
BELOW = 4

PARITY = 8  # words of 64 bits


@dataclass(frozen=True)
class JoinSettings:
    words: int = 5  # of a shingle
    percent: int = 80  # 100 * intersection >= percent * union
    growth: float = 1.5  # of a band's sizes
    missed_empty: float = 1e-9  # share of sets that may have more empty segments than they can leave out
    spread: int = 4096  # buckets that stand for a whole band
    broadcast_ids: int = 1_000_000  # ids of sets to compare; beyond that the texts are joined by shuffling


# --- sets of shingles


def shingle_sets(part: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, and where each row's begin (one more entry than rows).

    ASCII letters are lowered. A row with fewer than ``n`` words has its whole sequence as its one shingle, a row
    without words has none.
    """
    data = LOWER[part.data]
    starts, ends, row = part.words()
    hashes = span_hashes(data, starts, ends)
    shingles, first = grams(hashes, row, n)
    owner = row[first]
    counts = np.bincount(row, minlength=part.rows)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        begins = np.concatenate([[0], np.cumsum(counts)])[short]
        whole = mix(counts[short].astype(np.uint64))
        for k in range(n - 1):
            more = counts[short] > k
            whole[more] = mix(whole[more] * _STEP + hashes[begins[more] + k])
        order = np.argsort(np.concatenate([owner, short]), kind="stable")
        shingles, owner = np.concatenate([shingles, whole])[order], np.concatenate([owner, short])[order]
    bounds = np.searchsorted(owner, np.arange(part.rows + 1))
    sets = [np.unique(shingles[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def fingerprints(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit name of each set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ _STEP))])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def parities(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets, PARITY): bit k tells whether an odd number of the set's elements fall on k."""
    sets = len(bounds) - 1
    bit = (mix(values + _STEP) >> np.uint64(20)) % np.uint64(64 * PARITY)
    cell = np.repeat(np.arange(sets) * (64 * PARITY), np.diff(bounds)) + bit.astype(np.int64)
    odd = (np.bincount(cell, minlength=sets * 64 * PARITY) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(sets, 64 * PARITY), axis=1, bitorder="little").view("<i8")


# --- bands and their segments


@dataclass(frozen=True)
class Band:
    number: int
    low: int  # sizes from low to high
    high: int
    exact: int  # segments indexed as they are
    loose: int  # segments indexed with one-deletion subsets too
    spare: int  # how many segments any set may leave out


def _too_many(mean: float, spare: int) -> float:
    """The share of Poisson counts above ``spare``."""
    term = total = math.exp(-mean)
    for k in range(1, spare + 1):
        term *= mean / k
        total += term
    return max(0.0, 1 - total)


@lru_cache(maxsize=None)
def bands(settings: JoinSettings, largest: int) -> tuple[Band, ...]:
    """Bands for sizes from 1 up to ``largest`` at least, each with the cheapest segments that its pairs allow."""
    out: list[Band] = []
    low = 1
    while low <= largest:
        high = max(low, math.floor(low * settings.growth) - 1)
        # The larger partner has at most 100 / percent times the smaller one's size, and a pair that links differs
        # in at most (1 - s) / (1 + s) of its joint size.
        partner = high * 100 // settings.percent
        apart = (100 - settings.percent) * (high + partner) // (100 + settings.percent)
        best = None
        for loose in range(5):
            spare = 0
            while True:
                segments = apart + 1 + spare - loose  # a loose one counts twice: exact + 2 loose = apart + 1 + spare
                if segments >= max(loose, 1):
                    empty = segments * math.exp(-low / segments)
                    if _too_many(empty, spare) <= settings.missed_empty or spare > 2 * apart + 8:
                        rows = segments - empty + loose * high / segments
                        if best is None or rows < best[0]:
                            best = (rows, segments - loose, loose, spare)
                        break
                spare += 1 + spare // 16
        out.append(Band(len(out), low, high, *best[1:]))
        low = high + 1
    return tuple(out)


def _band_of(sizes: np.ndarray, settings: JoinSettings) -> tuple[tuple[Band, ...], np.ndarray]:
    every = bands(settings, 1 << int(sizes.max()).bit_length())
    lows = np.array([b.low for b in every])
    return every, np.searchsorted(lows, np.maximum(sizes, 1), "right") - 1


def signatures(
    values: np.ndarray, bounds: np.ndarray, settings: JoinSettings
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, set, tag, spare) for every set: ``spare`` is how many segments it may leave out beside its empty ones,
    and still find every partner that is not larger than itself."""
    sizes = np.diff(bounds)
    if not len(values):
        return
    every, own = _band_of(sizes, settings)
    for number in np.unique(own[sizes > 0]):
        for band in every[max(0, number - 1) : number + 1]:
            below = BELOW * (band.number != number)
            member = (own == number) & (sizes > 0)
            if below:
                member &= sizes * settings.percent <= 100 * band.high
            sets = np.flatnonzero(member)
            if not len(sets):
                continue
            length = sizes[sets]
            before = np.concatenate([[0], np.cumsum(length)])
            place = np.repeat(bounds[sets] - before[:-1], length) + np.arange(before[-1])
            seed = mix(np.array([band.number + 1], np.uint64) * _STEP)[0]
            element = mix(values[place] ^ seed)
            segments = band.exact + band.loose
            segment = (((element >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)
            cell = np.repeat(np.arange(len(sets)) * segments, length) + segment
            total = np.zeros(len(sets) * segments, np.uint64)
            np.add.at(total, cell, element)
            held = np.bincount(cell, minlength=len(total))
            filled = held > 0
            loose = np.arange(segments) >= band.exact
            # An empty segment is left out. A loose one with one element is used as if it were exact: without that
            # element it is empty, and nothing is indexed there.
            counts = held.reshape(len(sets), segments)
            partner = np.minimum(length, band.high)  # at most: a set looks for those not larger than itself
            apart = (100 - settings.percent) * (length + partner) // (100 + settings.percent)
            spare = band.exact + 2 * band.loose - 1 - apart - ((counts == 0) * np.where(loose, 2, 1) + (counts == 1) * loose).sum(axis=1)

            name = mix((np.arange(segments).astype(np.uint64) + np.uint64(1)) * _STEP + seed)
            at = np.flatnonzero(filled)
            in_segment = at % segments
            keys = mix(total[at] + name[in_segment])
            yield keys, sets[at // segments], below + np.where(loose[in_segment], LOOSE, EXACT), spare[at // segments]
            if band.loose:
                inside = np.flatnonzero((segment >= band.exact) & (held[cell] > 1))
                less = mix(total[cell[inside]] - element[inside] + name[segment[inside]])
                owner = cell[inside] // segments
                yield less, sets[owner], np.full(len(less), below + DELETION), spare[owner]

            # One place in the whole band, and all places for a set that cannot leave out all its empty segments.
            names = fingerprints(values, bounds)[sets]
            spots = mix(np.arange(settings.spread, dtype=np.uint64) + mix(seed + np.arange(1, dtype=np.uint64)))
            yield spots[names % np.uint64(settings.spread)], sets, np.full(len(sets), below + WHOLE), np.full(len(sets), 1)
            for k in np.flatnonzero(spare < 0):
                yield spots, np.full(len(spots), sets[k]), np.full(len(spots), below + WHOLE), np.full(len(spots), -1)


# --- the join


def _sized(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(docs[id].cast("long").alias("doc"), docs[text].cast("string").alias("text"))


def _sizes(rows: DataFrame, settings: JoinSettings) -> DataFrame:
    """(doc, n, name, parity) of every row; ``name`` is the same for equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts(batch.column(1)):
                values, bounds = shingle_sets(part, settings.words)
                names = pa.array(fingerprints(values, bounds).view(np.int64))
                parity = pa.ListArray.from_arrays(
                    np.arange(0, PARITY * part.rows + 1, PARITY, dtype=np.int32), pa.array(parities(values, bounds).ravel())
                )
                ids = batch.column(0).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(bounds)), names, parity], ["doc", "n", "name", "parity"]
                )

    return rows.mapInArrow(run, "doc long, n long, name long, parity array<long>")


def _may_link(a: str, b: str, settings: JoinSettings) -> Column:
    """Whether sizes and parities of two sets allow a link."""
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    bits = [F.bit_count(F.col(f"parity_{a}")[k].bitwiseXOR(F.col(f"parity_{b}")[k])) for k in range(PARITY)]
    apart = bits[0]
    for more in bits[1:]:
        apart = apart + more
    close = 100 * F.least(n_a, n_b) >= settings.percent * F.greatest(n_a, n_b)
    return close & ((100 + settings.percent) * apart <= (100 - settings.percent) * (n_a + n_b))


def _signature_rows(rows: DataFrame, settings: JoinSettings) -> DataFrame:
    """(key, doc, tag, spare) of every row that has an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts(batch.column(1)):
                ids = batch.column(0).slice(part.first, part.rows).to_numpy(zero_copy_only=False)
                for keys, owner, tag, spare in signatures(*shingle_sets(part, settings.words), settings):
                    columns = [keys.view(np.int64), ids[owner], tag.astype(np.int8), spare.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc", "tag", "spare"])

    return rows.where("doc is not null").mapInArrow(run, "key long, doc long, tag byte, spare int")


def _sets(rows: DataFrame, settings: JoinSettings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts(batch.column(1)):
                values, bounds = shingle_sets(part, settings.words)
                lists = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(values.view(np.int64)))
                names = pa.array(fingerprints(values, bounds).view(np.int64))
                ids = batch.column(0).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays([ids, names, lists], ["doc", "name", "shingles"])

    return rows.mapInArrow(run, "doc long, name long, shingles array<long>")


def _buckets(rows: DataFrame) -> DataFrame:
    """(key, doc, used, deletion) of the buckets with two documents or more. ``used`` tells whether a document looks
    for partners there, or leaves the bucket out."""
    kind = F.col("tag").bitwiseAND(F.lit(3).cast("byte"))
    key = Window.partitionBy("key")
    shared = rows.withColumn("docs", F.count("*").over(key)).where("docs > 1")
    # A loose segment costs two; its deletions are used in any case.
    cost = F.when(kind == EXACT, 1).when(kind == LOOSE, 2).otherwise(0)
    order = Window.partitionBy("doc", (F.col("tag") >= BELOW)).orderBy(F.col("docs").desc(), "key")
    spent = F.sum(cost).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    used = F.when(kind == WHOLE, F.col("spare") < 0).when(kind == DELETION, True).otherwise(F.col("spent") > F.col("spare"))
    return (
        shared.withColumn("spent", spent)
        .select("key", "doc", used.alias("used"), (kind == DELETION).alias("deletion"))
        .withColumn("any_used", F.max("used").over(key))
        .where("any_used")
        .drop("any_used")
    )


_SET = ("n", "name", "parity")


def _verified(pairs: DataFrame, rows: DataFrame, chosen: DataFrame, settings: JoinSettings) -> DataFrame:
    """The pairs (a, b) of documents that reach the threshold; ``chosen`` has each document's set once."""
    side = lambda s: chosen.select(F.col("doc").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in _SET])
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(_may_link("a", "b", settings))
    sized = durable(sized.drop("parity_a", "parity_b"), "candidates")
    same = (F.col("name_a") == F.col("name_b")) & (F.col("n_a") == F.col("n_b"))
    other = sized.where(~same)
    wanted = durable(
        other.select(F.col("a").alias("doc"), F.col("name_a").alias("name"))
        .unionByName(other.select(F.col("b").alias("doc"), F.col("name_b").alias("name")))
        .distinct(),
        "wanted",
    )
    if wanted.count() <= settings.broadcast_ids:
        wanted = F.broadcast(wanted)
    sets = durable(
        _sets(rows.join(wanted.select("doc").distinct(), "doc", "left_semi"), settings)
        .join(wanted, ["doc", "name"], "left_semi")
        .dropDuplicates(["doc"]),
        "sets",
    )
    side = lambda s: sets.select(F.col("doc").alias(s), F.col("shingles").alias(f"set_{s}"))
    both = other.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    close = both.select("a", "b", "n_a", "n_b", common.alias("common")).where(
        100 * F.col("common") >= settings.percent * (F.col("n_a") + F.col("n_b") - F.col("common"))
    )
    return durable(close.select("a", "b").unionByName(sized.where(same).select("a", "b")), "linked")


def link(docs: DataFrame, settings: JoinSettings = JoinSettings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    ``component_id`` is the smallest id reached by links, the row's own if it has none. Null and blank texts have no
    shingles and link with nothing, however many there are; equal sets link. A row with a null id keeps its place
    and has a null component. Rows that repeat an id are one document, that of the row with most shingles, and share
    its component. Other columns do not matter; an empty table gives no rows.
    """
    rows = _sized(docs, id, text)
    sizes = durable(_sizes(rows, settings), "set-sizes")
    chosen = durable(
        sizes.where("n > 0 and doc is not null")
        .groupBy("doc")
        .agg(F.max(F.struct(*_SET)).alias("set"))
        .select("doc", "set.*"),
        "set-names",
    )
    buckets = durable(_buckets(_signature_rows(rows, settings)), "buckets")
    key = Window.partitionBy("key")

    # Each document with the first one of its bucket.
    stars = (
        buckets.withColumn("first", F.min(F.struct("doc", "used", "deletion")).over(key))
        .where("first.doc <> doc and (used or first.used) and not (deletion and first.deletion)")
        .select(F.col("first.doc").alias("a"), F.col("doc").alias("b"))
        .distinct()
    )
    stars = durable(stars, "stars")
    linked = _verified(stars, rows, chosen, settings)
    groups = components(linked)

    # Then what is still apart in a bucket: documents outside the first one's component with all others, and its
    # members with them. Equal sets are in one component, so one of them stands for all.
    stands = chosen.groupBy("n", "name").agg(F.min("doc").alias("doc")).select("doc")
    placed = (
        buckets.join(stands, "doc", "left_semi")
        .join(groups.withColumnRenamed("node", "doc"), "doc", "left")
        .withColumn("component", F.coalesce("component", "doc"))
        .withColumn("main", F.min(F.struct("doc", "component")).over(key)["component"])
        .withColumn("apart", F.max(F.col("component") != F.col("main")).over(key))
        .where("apart")
        .select("key", "doc", "used", "deletion", "component", (F.col("component") == F.col("main")).alias("inside"))
    )
    placed = durable(placed.join(chosen.select("doc", "n", "parity"), "doc"), "apart")
    side = lambda s, df: df.select("key", *[F.col(c).alias(f"{c}_{s}") for c in placed.columns if c != "key"])
    looking, found = side("x", placed.where("used")), side("y", placed)
    fits = "component_x <> component_y and n_x >= n_y and not (deletion_x and deletion_y)"
    rest = (
        looking.where("not inside_x")
        .join(found, "key")
        .where(fits)
        .where(_may_link("x", "y", settings))
        .unionByName(
            looking.where("inside_x").join(found.where("not inside_y"), "key").where(fits).where(_may_link("x", "y", settings))
        )
        .select(F.least("doc_x", "doc_y").alias("a"), F.greatest("doc_x", "doc_y").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    more = _verified(rest, rows, chosen, settings)
    groups = components(linked.unionByName(more))
    return sizes.join(groups.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )


def keep_first(docs: DataFrame, settings: JoinSettings = JoinSettings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group, and all that are alone.

    Rows without an id stay. Of rows that repeat the id of a kept document, those with different texts stay, and of
    those with equal ones the smallest row stays. Columns may have any name.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), docs[id].cast("long").alias("key"), docs[text].cast("string").alias("said"))
    away = link(docs, settings, id, text).where("component_id <> doc_id").select(F.col("doc_id").alias("key")).distinct()
    again = rows.where("key IS NOT NULL").groupBy("key").count().where("count > 1").select("key").join(away, "key", "left_anti")
    again = durable(again, "jaccard-repeated")
    once = rows.join(away.unionByName(again), "key", "left_anti").select("doc.*")
    first = rows.join(again, "key", "left_semi").groupBy("key", "said").agg(F.min("doc").alias("doc"))
    return once.unionByName(first.select("doc.*"))
