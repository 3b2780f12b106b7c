"""Phrases whose words stand together more often than chance, per language, from a dictionary of chunks.

Each text is cut where the hash of four words in a row says so: content decides, so passages that repeat are cut alike
wherever they are. A chunk runs from one such window up to the end of the next one, so neighbours overlap by the four
words of a window, and every phrase of up to five words is whole in a chunk. The corpus becomes a dictionary of
distinct chunks with their frequencies. Phrases are counted inside the chunks of the dictionary, times the chunk's
frequency, by the chunk in whose own words (those before the overlap) they begin: so once.

Counting goes level by level. A phrase is frequent only if its words and its pairs of neighbours are: words are
counted first, then pairs of frequent words, and strings are only made of phrases all of whose pairs are frequent. What
is frequent is passed on as a bit per hash: an array of bounded size, in which a hash may be set that is not frequent.
That costs time, and changes nothing: the counts that decide are taken of the strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.textbytes import LOWER, Texts, grams, mix, span_hashes, texts
from tidewatch.session import durable

LEAST, TOP, LONGEST = 100, 2000, 5
MEAN_CHUNK = 24  # words from one cut to the next, on average
SIEVE_BITS = 1 << 28  # at most; 32 MB
_SIEVE_RATIO = 32  # bits per frequent hash, below that bound
_BLOCK = 1 << 21  # phrases counted before their sums are sent on
_SLICE = 8 << 20  # bytes of chunks

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _slices(begins: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given stretches of ``data`` end to end, and where each begins (one more entry than stretches)."""
    sizes = ends - begins
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.repeat(begins - offsets[:-1], sizes) + np.arange(offsets[-1])], offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.StringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2])


def _chunks_of(part: Texts, groups: np.ndarray, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct chunks of some texts: words with one space between them, or a line end between pieces; the number of
    own words, the group (one number per text) and the frequency of each."""
    data, overlap = LOWER[part.data], longest - 1
    starts, ends, rows = part.spans(~(_BLANK | _BREAK)[data])
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return pa.array([], pa.string()), none, none, none
    piece = np.cumsum(_BREAK[data])[starts]
    joined = np.append((rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1]), False)  # with the next word
    sizes = ends - starts + 1
    after = np.cumsum(sizes)
    clean, _ = _slices(starts, ends + 1, np.append(data, np.uint8(0)))
    clean[after - 1] = np.where(joined, 0x20, 0x0A)
    starts, ends = after - sizes, after - 1
    hashes = span_hashes(clean, starts, ends)
    windows, at = grams(hashes, rows, overlap)
    first = np.append(True, rows[1:] != rows[:-1])
    first[at[windows % np.uint64(MEAN_CHUNK) == 0]] = True
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], n)
    more, goes_on = np.zeros(len(begin), np.int64), np.ones(len(begin), bool)
    for k in range(overlap):  # of the next chunk's words those that a phrase begun here may hold
        goes_on &= joined[np.minimum(end - 1 + k, n - 1)]
        more += goes_on
    text, offsets = _slices(starts[begin], ends[end - 1 + more], clean)
    own, group = end - begin, groups[rows[begin]]
    names = span_hashes(text, offsets[:-1], offsets[1:])
    names = mix(names + mix(own.astype(np.uint64)) + mix(mix(group.astype(np.uint64) + np.uint64(7))))
    _, kept, times = np.unique(names, return_index=True, return_counts=True)
    text, offsets = _slices(offsets[kept], offsets[kept + 1], text)
    return _strings(text, offsets), own[kept], group[kept], times


def dictionary(docs: DataFrame, longest: int = LONGEST, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, own, chunk, times): the distinct chunks of all texts, how many of their words are their own, and how
    often each is there. Texts without a language are in ``und``."""
    rows = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes = langs.indices.to_numpy(zero_copy_only=False)
            for some in texts(batch.column(1)):
                chunks, own, group, times = _chunks_of(some, codes[some.first : some.first + some.rows], longest)
                columns = [langs.dictionary.take(pa.array(group)), pa.array(own), chunks, pa.array(times)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "own", "chunk", "times"])

    cut = rows.mapInArrow(run, "lang string, own long, chunk string, times long")
    return cut.groupBy("lang", "own", "chunk").agg(F.sum("times").alias("times"))


@dataclass
class Sieve:
    """A bit per hash, for a number of bits that is a power of two."""

    bits: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        slots = keys & np.uint64(64 * len(self.bits) - 1)
        return (self.bits[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def _sieve(keys: DataFrame) -> Sieve:
    """The sieve of a column ``key`` of longs. What comes to the driver is the sieve: at most ``SIEVE_BITS``."""
    size = 1 << 16
    wanted = _SIEVE_RATIO * keys.count()
    while size < min(wanted, SIEVE_BITS):
        size *= 2
    slot = F.col("key").bitwiseAND(F.lit(size - 1))
    parts = keys.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")
    )
    found = parts.toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Sieve(bits)


@dataclass
class _Words:
    """The words of some chunks: bounds, the piece each is in, its chunk, its hash (which tells languages apart), and
    whether a phrase that begins there is counted here."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    pieces: np.ndarray
    hashes: np.ndarray
    own: np.ndarray

    def grams(self, n: int, counted: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each phrase of ``n`` words inside a piece."""
        keys, at = grams(self.hashes, self.pieces, n)
        if counted:
            keys, at = keys[self.own[at]], at[self.own[at]]
        return keys, at

    def hits(self, sieve: Sieve, n: int) -> np.ndarray:
        """Whether a phrase of ``n`` words that is in the sieve begins at each word, counted here or not."""
        out = np.zeros(len(self.starts), bool)
        keys, at = self.grams(n, counted=False)
        out[at] = sieve.has(keys)
        return out


def _words(batch: pa.RecordBatch) -> Iterator[tuple[_Words, np.ndarray, pa.DictionaryArray]]:
    """The words of the chunks of a batch, with the frequencies of the chunks and their languages."""
    langs = batch.column(0).dictionary_encode()
    names = np.zeros(0, np.uint64)
    for name in texts(langs.dictionary, 1 << 30):
        names = span_hashes(name.data, name.offsets[:-1], name.offsets[1:])
    codes = langs.indices.to_numpy(zero_copy_only=False)
    own, times = batch.column(1).to_numpy(), batch.column(3).to_numpy()
    for some in texts(batch.column(2), _SLICE):
        here = slice(some.first, some.first + some.rows)
        starts, ends, rows = some.spans((some.data != 0x20) & (some.data != 0x0A))
        line = np.cumsum(some.data == 0x0A)[starts] if len(starts) else starts
        new = np.ones(len(starts), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (line[1:] != line[:-1])
        first = np.searchsorted(rows, np.arange(some.rows))
        place = np.arange(len(starts)) - first[rows]
        hashes = mix(span_hashes(some.data, starts, ends) ^ mix(names[codes[here]])[rows])
        words = _Words(some.data, starts, ends, rows, np.cumsum(new), hashes, place < own[here][rows])
        yield words, times[here], langs.slice(some.first, some.rows)


_Keys = Callable[[_Words], tuple[np.ndarray, np.ndarray]]


def _frequent_keys(chunks: DataFrame, keys: _Keys, least: int, label: str) -> Sieve:
    """The sieve of all hashes that ``keys`` gives at least ``least`` times over the corpus."""

    def sums(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        different, which = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        times = np.zeros(len(different), np.int64)
        np.add.at(times, which, np.concatenate([t for _, t in held]))
        return pa.RecordBatch.from_arrays([pa.array(different.view(np.int64)), pa.array(times)], ["key", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for words, times, _ in _words(batch):
                found, at = keys(words)
                held.append((found, times[words.rows[at]]))
                n += len(found)
                if n >= _BLOCK:
                    yield sums(held)
                    held, n = [], 0
        if held:
            yield sums(held)

    counted = chunks.mapInArrow(run, "key long, times long").groupBy("key").agg(F.sum("times").alias("times"))
    return _sieve(durable(counted.where(F.col("times") >= least).select("key"), label))


def frequent(chunks: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, n_words, f) of all phrases of up to ``longest`` words that are in the corpus at least ``least``
    times, from its dictionary."""
    spark = chunks.sparkSession
    single = spark.sparkContext.broadcast(_frequent_keys(chunks, lambda w: w.grams(1), least, "phrases-words"))

    def pairs(words: _Words) -> tuple[np.ndarray, np.ndarray]:
        hit = words.hits(single.value, 1)
        keys, at = words.grams(2)
        good = hit[at] & hit[at + 1]
        return keys[good], at[good]

    double = spark.sparkContext.broadcast(_frequent_keys(chunks, pairs, least, "phrases-pairs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, times, langs in _words(batch):
                if not len(words.starts):
                    continue
                hit = words.hits(double.value, 2)
                for n in range(1, longest + 1):
                    keys, at = words.grams(n)
                    if n == 1:
                        good = single.value.has(keys)
                    else:
                        good = hit[at]
                        for k in range(1, n - 1):
                            good &= hit[at + k]
                    keys, at = keys[good], at[good]
                    if not len(at):
                        continue
                    _, kept, which = np.unique(keys, return_index=True, return_inverse=True)
                    f = np.zeros(len(kept), np.int64)
                    np.add.at(f, which, times[words.rows[at]])
                    at = at[kept]
                    phrases = _strings(*_slices(words.starts[at], words.ends[at + n - 1], words.data))
                    lang = langs.take(pa.array(words.rows[at])).cast(pa.string())
                    size = pa.array(np.full(len(at), n, np.int32))
                    yield pa.RecordBatch.from_arrays([lang, phrases, size, pa.array(f)], ["lang", "phrase", "n_words", "f"])

    found = chunks.mapInArrow(run, "lang string, phrase string, n_words int, f long")
    return found.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two and more words with their lowest-scoring cut, the first of several."""
    cut = phrases.where("n_words >= 2").select("lang", "phrase", F.col("f").alias("a"), F.expr("explode(sequence(1, n_words - 1)) AS k"))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cut = cut.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    exact = "(cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r)"
    lowest = both.groupBy("lang", "phrase").agg(
        F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n")
    )
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _inside(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the frequency of the most frequent longer phrase that each one is part of."""
    parts = F.expr(
        "explode(flatten(transform(sequence(2, n_words - 1), m -> transform(sequence(1, n_words - m + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, m), ' '))))) AS phrase"
    )
    parts = phrases.where("n_words >= 3").select("lang", "f", parts)
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """The ``top`` phrases of each language by score: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased in ASCII and split at ``.,;:!?`` and line ends into pieces, and at blanks into words. A
    phrase has 2 to ``longest`` words inside a piece and is there ``a >= least`` times. Its score is the lowest
    ``floor(1000 * a * n / (l * r))`` over its cuts in two, of frequencies ``l`` and ``r``, with ``n`` words in the
    language. Phrases that are as frequent inside a longer one are left out. Order is by score, then ``a``, both
    descending, then phrase.

    Null and empty texts have no words; a null language is ``und``; repeated rows count again; an empty table gives no
    rows; other columns are not read.
    """
    chunks = durable(dictionary(docs, longest, lang, text), "phrases-chunks")
    phrases = durable(frequent(chunks, least, longest), "phrases-frequent")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    scored = _scored(phrases, totals).join(_inside(phrases), ["lang", "phrase"], "left")
    scored = scored.where("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
