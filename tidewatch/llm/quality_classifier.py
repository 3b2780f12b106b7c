"""Quality scores from gradient-boosted trees over statistics of the whole text.

Texts are read once, for their statistics. The trees are fitted on the driver, on a sample of labelled rows with a
fixed bound, drawn by a hash of the id; every document is then scored from its statistics in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.boosting import BoostSettings, Trees, fit
from tidewatch.llm.docstats import COUNTS, count
from tidewatch.llm.textbytes import texts
from tidewatch.session import durable


@dataclass(frozen=True)
class ClassifierSettings:
    sample_rows: int = 20_000  # the most labelled rows that are learned from
    good: float = 0.7  # scores from here on are predicted 1
    boost: BoostSettings = field(default_factory=BoostSettings)


def vectors(counts: dict[str, np.ndarray]) -> np.ndarray:
    """What the trees see of a text: its length, and shares and means that do not depend on it."""
    c = {name: counts[name].astype(float) for name in COUNTS}
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
    return np.stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / chars,
            c["n_upper"] / np.maximum(c["n_letters"], 1),
            c["n_punctuation"] / chars,
            c["n_digits"] / chars,
            c["n_letters"] / chars,
            c["n_distinct_words"] / words,
            c["n_distinct_words"] / np.sqrt(words),
            c["n_repeat_words"] / words,
            c["n_dup_lines"] / lines,
            c["n_words"] / lines,
            c["n_spaces"] / words,
        ],
        axis=1,
    )


def with_vectors(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts(batch.column(1)):
                x = vectors(count(part))
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, part.rows), lists], ["doc_id", "x"])

    rows = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def sample(labelled: DataFrame, size: int) -> DataFrame:
    """The ``size`` first rows by the hash of their id. Counts by the hash's first 16 bits say how far they reach, so
    only these rows are sorted and sent, however many partitions there are."""
    hashed = labelled.withColumn("hash", F.xxhash64("doc_id"))
    reach = F.shiftright("hash", 48).cast("int")
    counts = hashed.groupBy(reach.alias("reach")).agg(F.count("*").alias("n")).orderBy("reach").toArrow()
    reached = np.flatnonzero(np.cumsum(counts["n"].to_numpy()) >= size)
    if len(reached):
        hashed = hashed.where(reach <= F.lit(counts["reach"][int(reached[0])].as_py()))
    return hashed.orderBy("hash", "doc_id", "label").limit(size).drop("hash")


def learn(labelled: DataFrame, settings: ClassifierSettings) -> Trees:
    """Trees from rows (doc_id, x, label): the ``sample_rows`` first by the hash of their id."""
    rows = sample(labelled, settings.sample_rows).select("x", "label").toArrow()
    n = rows.num_rows
    y = rows["label"].to_numpy().astype(float) if n else np.zeros(0)
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 1))
    return fit(x, y, settings.boost)


def scored(rows: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) from (doc_id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.probabilities(x))], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    settings: ClassifierSettings = ClassifierSettings(),
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``. ``learn_from`` is a condition on the column ``doc_id``:
    only labels of such documents are learned.

    Null text counts as empty and is scored like any other. Rows without an id are scored, but not learned from; nor
    are null labels. Rows that repeat an id are scored each. Without labels, or with labels of one kind, every score
    is the share of ones, drawn towards a half. Other columns do not matter; an empty table gives no rows.
    """
    rows = durable(with_vectors(docs, id, text), "quality-vectors")
    known = labels.select(labels[id].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.coalesce(learn_from, F.lit(False)))
    trees = learn(rows.join(known, "doc_id"), settings)
    return scored(rows, trees).withColumn("predicted", (F.col("score") >= settings.good).cast("int"))
