"""Masked pseudo-likelihood: a network that predicts each token from the tokens on both sides of it.

A word has a class. The most frequent words of the whole corpus are classes of their own; the others share buckets by
their last two bytes, which tell language and shape. With one word to each side, all that the network can learn from a
corpus is how often each (left, class, right) occurs. These counts are taken over every document, by sums that no
task holds more than ``vocabulary ** 3`` of. The network is trained on them in numpy; ``score`` sums its
log p(class | left, right).

Which word of its class a word is comes from the counts of all words of all documents, a table in Spark that grows
with the corpus. ``score_words`` sums log p(class | left, right) + log p(word | class). The commonest words are looked
up where the text is; all others meet their counts in a join. The sides count by their classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textbytes import LOWER, Texts, span_hashes, texts
from tidewatch.session import durable

BOUNDARY = 0  # before the first and after the last token of a text


@dataclass(frozen=True)
class LmSettings:
    vocabulary: int = 128  # the boundary, frequent words, and buckets
    buckets: int = 31
    embedding: int = 16
    hidden: int = 48
    steps: int = 150
    rate: float = 0.03
    seed: int = 11
    held_words: int = 1 << 20  # different words a task counts before it passes them on
    sent_words: int = 1 << 18  # words whose counts every task has; the rest are joined
    unseen: float = 0.5  # added to the count of each word of a class, and of one word more


@dataclass(frozen=True)
class LanguageModel:
    words: np.ndarray  # hashes of the frequent words, ascending; their places + 1 are their tokens
    buckets: int
    left: np.ndarray
    right: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def table(self) -> np.ndarray:
        """log p(token | left, right) for all of them, as [left, right, token]."""
        v = len(self.left)
        pairs = np.stack(np.divmod(np.arange(v * v), v), axis=1)
        return _log_softmax(self._logits(pairs)[1]).reshape(v, v, v).astype(np.float32)

    def _logits(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen = np.concatenate([self.left[pairs[:, 0]], self.right[pairs[:, 1]]], axis=1)
        answers = np.tanh(seen @ self.hidden + self.hidden_bias)
        logits = answers @ self.out + self.out_bias
        logits[:, BOUNDARY] = -1e9  # never a token of a text
        return np.concatenate([seen, answers], axis=1), logits


@dataclass(frozen=True)
class WordModel:
    classes: LanguageModel
    counts: DataFrame  # (word, bucket, n) of every word that shares a bucket; a written table
    totals: np.ndarray  # log of what the counts of each bucket add up to, with those of ``unseen``
    settings: LmSettings


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _word_hashes(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, hash of the last two bytes, and row of each word; ASCII letters lowered."""
    data = LOWER[part.data]
    starts, ends, rows = part.words()
    return span_hashes(data, starts, ends), span_hashes(data, np.maximum(starts, ends - 2), ends), rows


def _tokens(part: Texts, words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows' tokens, each row between two boundaries, and the row of each."""
    hashes, endings, rows = _word_hashes(part)
    at = np.searchsorted(words, hashes)
    known = at < len(words)
    known[known] = words[at[known]] == hashes[known]
    token = np.where(known, at + 1, 1 + len(words) + (endings % np.uint64(buckets)).astype(np.int64))
    counts = np.bincount(rows, minlength=part.rows)
    out = np.zeros(len(token) + 2 * part.rows, np.int64)
    out[np.arange(len(token)) + 2 * rows + 1] = token
    return out, np.repeat(np.arange(part.rows), counts + 2)


def _text(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(docs[text].cast("string").alias("text"))


def word_counts(docs: DataFrame, settings: LmSettings, text: str = "text") -> DataFrame:
    """(word, bucket, n) of every word of every text; ``word`` is its hash, ``bucket`` the one its ending has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, buckets, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(buckets), pa.array(counts)], ["word", "bucket", "n"])
        for batch in batches:
            for part in texts(batch.column(0)):
                hashes, endings, _ = _word_hashes(part)
                new, at, n = np.unique(hashes, return_index=True, return_counts=True)
                ends = (endings[at] % np.uint64(settings.buckets)).astype(np.int64)
                merged, first, place = np.unique(np.concatenate([words, new]), return_index=True, return_inverse=True)
                total = np.zeros(len(merged), np.int64)
                np.add.at(total, place, np.concatenate([counts, n]))
                words, buckets, counts = merged, np.concatenate([buckets, ends])[first], total
                if len(words) > settings.held_words:
                    yield out()
                    words, buckets, counts = words[:0], buckets[:0], counts[:0]
        yield out()

    rows = _text(docs, text).mapInArrow(run, "word long, bucket long, n long")
    return rows.groupBy("word").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n"))


def triple_counts(docs: DataFrame, words: np.ndarray, settings: LmSettings, text: str = "text") -> DataFrame:
    """(code, n) with code = (left * V + token) * V + right, over every token of every text."""
    v, buckets = settings.vocabulary, settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(v**3, np.int64)
        for batch in batches:
            for part in texts(batch.column(0)):
                token, _ = _tokens(part, words, buckets)
                middle = np.flatnonzero(token[1:-1] != BOUNDARY) + 1
                code = (token[middle - 1] * v + token[middle]) * v + token[middle + 1]
                codes, n = np.unique(code, return_counts=True)
                total[codes] += n
        codes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(total[codes])], ["code", "n"])

    return _text(docs, text).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def train(counts: np.ndarray, words: np.ndarray, settings: LmSettings) -> LanguageModel:
    """Adam on the mean log loss over all counts [left, token, right]."""
    v, rng = settings.vocabulary, np.random.default_rng(settings.seed)
    by_context = counts.transpose(0, 2, 1).reshape(v * v, v).astype(np.float64)
    used = np.flatnonzero(by_context.sum(axis=1))
    goal = (by_context[used] / max(1.0, by_context.sum())).astype(np.float32)
    mass = goal.sum(axis=1, keepdims=True)
    pairs = np.stack(np.divmod(used, v), axis=1)
    d, h = settings.embedding, settings.hidden
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    names = ("left", "right", "hidden", "hidden_bias", "out", "out_bias")
    frequency = counts.sum(axis=(0, 2)) + 1.0
    values = [normal(v, d) * 3, normal(v, d) * 3, normal(2 * d, h), np.zeros(h, np.float32), normal(h, v) * 0.1]
    values.append(np.log(frequency / frequency.sum()).astype(np.float32))
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in values]
    for step in range(1, settings.steps + 1 if len(used) else 1):
        model = LanguageModel(words, settings.buckets, **dict(zip(names, values, strict=True)))
        both, logits = model._logits(pairs)
        seen, answers = both[:, : 2 * d], both[:, 2 * d :]
        error = np.exp(_log_softmax(logits)) * mass - goal
        back = (error @ model.out.T) * (1 - answers * answers)
        to_seen = back @ model.hidden.T
        sides = []
        for side, part in ((0, to_seen[:, :d]), (1, to_seen[:, d:])):
            sides.append(np.stack([np.bincount(pairs[:, side], part[:, j], v) for j in range(d)], axis=1))
        grads = [*sides, seen.T @ back, back.sum(axis=0), answers.T @ error, error.sum(axis=0)]
        rate = settings.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for x, g, (m, s) in zip(values, grads, moments, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            x -= (rate * m / (np.sqrt(s) + 1e-10)).astype(np.float32)
    return LanguageModel(words, settings.buckets, **dict(zip(names, values, strict=True)))


def _learn(docs: DataFrame, counted: DataFrame, settings: LmSettings, text: str) -> LanguageModel:
    frequent = counted.orderBy(F.desc("n"), "word").limit(settings.vocabulary - 1 - settings.buckets)
    words = np.sort(np.array([r.word for r in frequent.collect()], np.int64).view(np.uint64))
    rows = triple_counts(docs, words, settings, text).toArrow()
    counts = np.zeros(settings.vocabulary**3, np.int64)
    counts[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return train(counts.reshape((settings.vocabulary,) * 3), words, settings)


def learn(docs: DataFrame, settings: LmSettings = LmSettings(), text: str = "text") -> LanguageModel:
    """The classes' model of all texts. What comes to the driver is the frequent words and the counts of triples, both
    bounded."""
    return _learn(docs, word_counts(docs, settings, text), settings, text)


def learn_words(docs: DataFrame, settings: LmSettings = LmSettings(), text: str = "text") -> WordModel:
    """The words' model of all texts: the classes' model, and the counts of all words in buckets, which stay in Spark."""
    counted = durable(word_counts(docs, settings, text), "lm-words")
    classes = _learn(docs, counted, settings, text)
    known = [int(w) for w in classes.words.view(np.int64)]
    counts = counted.where(~F.col("word").isin(known)) if known else counted
    totals = np.full(settings.buckets, settings.unseen)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        totals[r.bucket] += r.n + settings.unseen * r.words
    return WordModel(classes, counts, np.log(totals), settings)


def score(docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log_prob, per_token) of every row: the sum over its tokens, and their mean.

    A null or blank text has no tokens, log_prob 0 and a null mean. Rows that repeat an id, or have none, get a row
    each; equal texts get equal scores. Other columns do not matter; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            for part in texts(batch.column(1)):
                token, rows = _tokens(part, model.words, model.buckets)
                middle = np.flatnonzero(token[1:-1] != BOUNDARY) + 1
                logs = table[token[middle - 1], token[middle + 1], token[middle]].astype(np.float64)
                n = np.bincount(rows[middle], minlength=part.rows)
                total = np.bincount(rows[middle], logs, part.rows).astype(np.float64)
                mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
                ids = batch.column(0).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(total), mean], ["doc_id", "n_tokens", "log_prob", "per_token"])

    rows = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, log_prob double, per_token double")


_UNIT = 1e9  # logs that meet in Spark are added as whole numbers of 1 / _UNIT, so their order does not matter


def score_words(docs: DataFrame, model: WordModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log_prob, per_token) of every row, as ``score`` has them, with log p(word | left, right) in
    place of log p(class | left, right). All words that the model has not seen count as one word of their bucket."""
    classes, totals, unseen = model.classes, model.totals, model.settings.unseen
    first_bucket = 1 + len(classes.words)
    # Where the table holds no more words than are sent, a word that is not among them was not seen.
    sent = model.counts.orderBy(F.desc("n"), "word").limit(model.settings.sent_words + 1).select("word", "n").toArrow()
    every = len(sent) <= model.settings.sent_words
    sent = sent.slice(0, model.settings.sent_words)
    common = sent["word"].to_numpy().view(np.uint64)
    order = np.argsort(common)
    common, logs = common[order], np.log(sent["n"].to_numpy()[order] + unseen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.table()
        for batch in batches:
            for part in texts(batch.column(2)):
                token, rows = _tokens(part, classes.words, classes.buckets)
                middle = np.flatnonzero(token[1:-1] != BOUNDARY) + 1
                answer = table[token[middle - 1], token[middle + 1], token[middle]].astype(np.float64)
                rows, bucket = rows[middle], token[middle] - first_bucket
                shared = np.flatnonzero(bucket >= 0)
                hashes = _word_hashes(part)[0][shared]
                answer[shared] -= totals[bucket[shared]]
                at = np.searchsorted(common, hashes)
                found = at < len(common)
                found[found] = common[at[found]] == hashes[found]
                answer[shared[found]] += logs[at[found]]
                if every:
                    answer[shared[~found]] += np.log(unseen)
                rest = np.zeros(0, np.int64) if every else np.flatnonzero(~found)
                n = np.bincount(rows, minlength=part.rows)
                total = np.bincount(rows, answer, part.rows).astype(np.float64)
                edges = np.concatenate([[0], np.cumsum(np.bincount(rows[shared[rest]], minlength=part.rows))])
                words = pa.ListArray.from_arrays(edges.astype(np.int32), pa.array(hashes[rest].view(np.int64)))
                row, ids = (batch.column(k).slice(part.first, part.rows) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([row, ids, pa.array(n), pa.array(total), words], ["row", "doc_id", "n_tokens", "local", "words"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    scored = rows.mapInArrow(run, "row long, doc_id long, n_tokens long, local double, words array<long>")
    log_prob = F.col("local")
    if not every:
        scored = durable(scored, "lm-scores")
        rare = scored.select("row", F.explode("words").alias("word")).join(model.counts.select("word", "n"), "word", "left")
        log = F.round(F.log(F.coalesce("n", F.lit(0)) + F.lit(unseen)) * _UNIT).cast("long")
        sums = rare.groupBy("row").agg(F.sum(log).alias("joined"))
        scored = scored.drop("words").join(sums, "row", "left")
        log_prob = log_prob + F.coalesce("joined", F.lit(0)) / _UNIT
    scored = scored.select("doc_id", "n_tokens", log_prob.alias("log_prob"))
    return scored.withColumn("per_token", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
