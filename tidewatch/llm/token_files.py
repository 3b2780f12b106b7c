"""Token ids as files: encode whole texts, write the ids in ascending document order, read them back.

A file row is a run of whole documents: their ids and lengths, and all their token ids in the coding of
``simple8b``. Documents are put in order by ranges, so the files of all partitions, one after the other, are one long
sequence; a row knows how many ids its partition has before it, so only one number per partition is added up.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm import simple8b
from tidewatch.llm.textbytes import LOWER, Texts, span_hashes, texts
from tidewatch.session import new_folder

END_ID = 1
_CACHED = 1 << 20  # words an encoder remembers
_RUN = 1 << 20  # bytes of text in a file row, or one document

# Bytes that a word may end in without touching the token before them, when that ends in a letter or a digit. The
# apostrophe is left out: contractions are tokens of their own.
_TAIL = np.isin(np.arange(256), np.frombuffer(b'!"#$%&()*+,-./:;=?@[]^_`{|}~', np.uint8))
_ASCII_LETTER = ((np.arange(256) | 32) >= 97) & ((np.arange(256) | 32) <= 122) & (np.arange(256) < 128)


class WordEncoder:
    """A tokenizer that drops white space, applied to each different word once.

    Such a tokenizer gives a text the ids of its words, one after the other. Words are split further only where that
    cannot change ids: ASCII punctuation at the end of a word that otherwise ends in a Latin letter or a digit.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _units(self, part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes with ASCII letters lowered, and start, end and row of each unit to encode."""
        starts, ends, rows = part.words()
        data = part.data
        if not len(starts):
            return data, starts, ends, rows
        lowered = LOWER[data]
        solid = np.where(_TAIL[data], -1, np.arange(len(data)))
        core = np.minimum(np.maximum.accumulate(solid)[ends - 1] + 1, ends)
        last = data[np.maximum(core - 1, 0)]
        before = data[np.maximum(core - 2, 0)]
        latin = (before == 0xC3) & (last != 0x97) & (last != 0xB7) & (last >= 0x80)
        digit = (last >= 48) & (last <= 57)
        split = (core > starts) & (core < ends) & (_ASCII_LETTER[last] | digit | (latin & (core - starts >= 2)))
        angle = np.flatnonzero(data == 60)
        if len(angle):  # may be a special token, which has its own case
            whole = np.unique(np.searchsorted(starts, angle, "right") - 1)
            split[whole] = False
            for w in whole:
                lowered[starts[w] : ends[w]] = data[starts[w] : ends[w]]
        at = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(split)[:-1]])
        n = len(starts) + int(split.sum())
        unit_starts, unit_ends, unit_rows = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        unit_starts[at], unit_rows[at] = starts, rows
        unit_ends[at] = np.where(split, core, ends)
        tails = at[split] + 1
        unit_starts[tails], unit_ends[tails], unit_rows[tails] = core[split], ends[split], rows[split]
        return lowered, unit_starts, unit_ends, unit_rows

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words one after the other, how many each has, and in which order the words are there."""
        plain = [i for i, w in enumerate(words) if w.isalpha()]  # one token before merging, so its end can be seen
        flat, lengths, order, rest = [], [], [], [i for i, w in enumerate(words) if not w.isalpha()]
        for a in range(0, len(plain), 512):
            some = plain[a : a + 512]
            joined = self.tokenizer.encode(" ".join([words[i] for i in some]), add_special_tokens=False).ids
            joined = np.array(joined, np.int32)
            cuts = np.flatnonzero(self.ends_word[joined])
            if len(cuts) == len(some):
                flat.append(joined)
                lengths.append(np.diff(cuts, prepend=-1))
                order += some
            else:
                rest += some
        for i, one in zip(rest, self.tokenizer.encode_batch([words[i] for i in rest], add_special_tokens=False), strict=True):
            flat.append(np.array(one.ids, np.int32))
            lengths.append(np.array([len(one.ids)], np.int64))
            order.append(i)
        return np.concatenate(flat), np.concatenate(lengths), np.array(order)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Adds the ids of words that are not known yet; ``keys`` ascend."""
        flat, lengths, order = self._coded(words)
        begins = np.empty(len(keys), np.int64)
        counts = np.empty(len(keys), np.int64)
        begins[order] = len(self.ids) + np.cumsum(lengths) - lengths
        counts[order] = lengths
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begins = np.insert(self.begins, at, begins)
        self.lengths = np.insert(self.lengths, at, counts)
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and how many each row has."""
        data, starts, ends, rows = self._units(part)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(part.rows, np.int64)
        different, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(different) > _CACHED:
            self._forget()
        at = np.searchsorted(self.keys, different)
        new = np.ones(len(different), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != different[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(different[new], [raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in first[new]])
            at = np.searchsorted(self.keys, different)
        begins, lengths = self.begins[at][which], self.lengths[at][which]
        total = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(begins - total[:-1], lengths) + np.arange(total[-1])
        counts = np.diff(total[np.searchsorted(rows, np.arange(part.rows + 1))])
        return self.ids[place], counts


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and tokenizer."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(len(ids) + len(counts), end_id, np.int64)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out, counts + 1


_FILE = "part int, before long, n_docs int, n_ids long, doc_ids array<long>, lengths array<long>, ids binary"


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id: str = "doc_id", text: str = "text"
) -> None:
    """Writes the ids of every text of ``docs`` to ``folder``, in ascending order of ``id`` (null first, and equal ids
    by text), each document followed by ``end_id``. A null or blank text has that only."""
    rows = docs.select(docs[id].cast("long").alias("doc"), docs[text].cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc").sortWithinPartitions("doc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        words = encoder(tokenizer)
        for batch in batches:
            for some in texts(batch.column(1), _RUN):
                ids, lengths = _with_end(*words.encode(some), end_id)
                owners = batch.column(0).slice(some.first, some.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([before]),
                        pa.array([some.rows], pa.int32()),
                        pa.array([len(ids)]),
                        pa.ListArray.from_arrays(pa.array([0, some.rows], pa.int32()), owners),
                        pa.array([lengths.tolist()], pa.list_(pa.int64())),
                        pa.array([simple8b.encode(ids)], pa.binary()),
                    ],
                    ["part", "before", "n_docs", "n_ids", "doc_ids", "lengths", "ids"],
                )
                before += len(ids)

    ordered.mapInArrow(run, _FILE).write.mode("error").parquet(folder)


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """The file rows with ``base``, the ids of all partitions before theirs."""
    files = spark.read.schema(_FILE).parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("total"))  # one row per partition of the writing job
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(parts), "part")


def _read(spark: SparkSession, folder: str, schema: str, columns) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = simple8b.decode(row.column("ids")[0].as_py())
                lengths = row.column("lengths").flatten().to_numpy()
                ends = np.cumsum(lengths)
                starts = row.column("base")[0].as_py() + row.column("before")[0].as_py() + ends - lengths
                first = [row.column("doc_ids").flatten(), pa.array(starts)]
                yield pa.RecordBatch.from_arrays([*first, *columns(ids, lengths, ends)], names)

    names = [c.split()[0] for c in schema.split(", ")]
    placed = _placed(spark, folder).select("base", "before", "doc_ids", "lengths", "ids")
    return placed.mapInArrow(run, schema)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the files; ``start`` counts the ids of all documents before it."""

    def columns(ids, lengths, ends):
        return [pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(ids.astype(np.int64)))]

    return _read(spark, folder, "doc_id long, start long, ids array<long>", columns)


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; the checksum is over its ids as
    little-endian unsigned 32-bit integers."""

    def columns(ids, lengths, ends):
        raw = memoryview(ids.astype("<u4").tobytes())
        sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
        return [pa.array(lengths), pa.array(sums, pa.int64())]

    return _read(spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long", columns)


def tokenize(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes token files to a new folder in the shared one and returns ``read_digests`` of them."""
    folder = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, id=id, text=text)
    return read_digests(docs.sparkSession, folder)
