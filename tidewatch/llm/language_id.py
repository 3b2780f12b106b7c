"""Language identification by a convolutional network on bytes.

Bytes are embedded; filters of several widths slide over a window of fixed length; each filter's largest answer goes
to a softmax over the languages. The network is trained in numpy on the driver, on a bounded sample of labelled text,
and applied in the tasks to all windows of every whole text; a document's probabilities are the mean of its windows',
weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textbytes import Texts, texts

UNKNOWN = "und"
_LETTER = ((np.arange(256) | 32) >= 97) & ((np.arange(256) | 32) <= 122) & (np.arange(256) < 128)


@dataclass(frozen=True)
class NetSettings:
    window: int = 160  # bytes
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12  # of each width
    # The bound of the training sample: so many documents of each language (the first of each of so many hash strata),
    # with so many stretches of each.
    strata: int = 600
    languages: int = 200  # those with most documents
    stretches: int = 2
    epochs: int = 8
    batch: int = 128
    shortened: float = 0.5  # share of the windows that are cut, at least to ``shortest``, so short texts are known
    shortest: int = 8
    rate: float = 0.01
    seed: int = 7


@dataclass
class Net:
    labels: list[str]
    widest: int
    embed: np.ndarray  # (257, embedding); 256 stands for what is beyond a text's end
    filters: np.ndarray  # (widest * embedding, all filters), with zeros beyond a filter's width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def gathered(self, windows: np.ndarray) -> np.ndarray:
        """For each place of each window, the embeddings of the bytes a filter can see from there."""
        e = self.embed[windows]
        places = windows.shape[1] - self.widest + 1
        return np.concatenate([e[:, k : k + places] for k in range(self.widest)], axis=2)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        seen = self.gathered(windows)
        answers = (seen.reshape(-1, seen.shape[2]) @ self.filters).reshape(len(windows), seen.shape[1], -1)
        pooled = np.maximum(answers.max(axis=1) + self.bias, 0)
        logits = pooled @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, targets: np.ndarray, labels: list[str], settings: NetSettings) -> Net:
    """Adam on the cross entropy; each language weighs the same."""
    rng = np.random.default_rng(settings.seed)
    widest, d = max(settings.widths), settings.embedding
    total = settings.filters * len(settings.widths)
    mask = np.zeros((widest * d, total), np.float32)
    for k, width in enumerate(settings.widths):
        mask[: width * d, k * settings.filters : (k + 1) * settings.filters] = 1
    normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    net = Net(
        labels,
        widest,
        normal(257, d) * 0.5,
        normal(widest * d, total) * mask / np.sqrt(widest * d),
        np.zeros(total, np.float32),
        normal(total, len(labels)) / np.sqrt(total),
        np.zeros(len(labels), np.float32),
    )
    names = ("embed", "filters", "bias", "out", "out_bias")
    moments = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in names}
    share = np.bincount(targets, minlength=len(labels))
    weight = (len(targets) / np.maximum(share, 1) / max(1, (share > 0).sum())).astype(np.float32)
    step = 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), settings.batch):
            some = order[a : a + settings.batch]
            w, t = windows[some], targets[some]
            short = rng.random(len(w)) < settings.shortened
            ends = np.where(short, rng.integers(settings.shortest, w.shape[1], len(w)), w.shape[1])
            w[np.arange(w.shape[1]) >= ends[:, None]] = 256
            seen = net.gathered(w)
            answers = (seen.reshape(-1, seen.shape[2]) @ net.filters).reshape(len(w), seen.shape[1], -1)
            place = answers.argmax(axis=1)
            pooled = np.take_along_axis(answers, place[:, None], 1)[:, 0] + net.bias
            active = np.maximum(pooled, 0)
            logits = active @ net.out + net.out_bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(t)), t] -= 1
            p *= weight[t][:, None] / len(t)
            back = (p @ net.out.T) * (pooled > 0)
            at = seen[np.arange(len(w))[:, None], place]  # (batch, filters, widest * d)
            filters = np.einsum("bfk,bf->kf", at, back) * mask
            to_seen = (back[:, :, None] * net.filters.T[None]).reshape(-1, d)
            which = w[np.arange(len(w))[:, None, None], place[:, :, None] + np.arange(widest)].ravel()
            embed = np.stack([np.bincount(which, to_seen[:, j], 257) for j in range(d)], axis=1)
            step += 1
            for n, grad in zip(names, (embed, filters, back.sum(0), active.T @ p, p.sum(0)), strict=True):
                m, v = moments[n]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                rate = settings.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                getattr(net, n).__isub__((rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32))
    return net


def windows_of(part: Texts, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of all rows (256 beyond a row's end), the row and the number of bytes of each."""
    lengths = np.diff(part.offsets)
    counts = -(-lengths // window)
    rows = np.repeat(np.arange(part.rows), counts)
    index = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = part.offsets[rows] + index * window
    sizes = np.minimum(window, part.offsets[rows + 1] - starts)
    padded = np.concatenate([part.data, np.zeros(window, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, window)[starts].astype(np.int16)
    out[np.arange(window) >= sizes[:, None]] = 256
    return out, rows, sizes


def _has_letter(part: Texts) -> np.ndarray:
    found = part.sums(_LETTER[part.data]) > 0
    other = np.flatnonzero(~found & (part.sums(part.data >= 0x80) > 0))
    for row in other:
        raw = part.data[part.offsets[row] : part.offsets[row + 1]].tobytes()
        found[row] = any(c.isalpha() for c in raw.decode("utf-8", "replace"))
    return found


def learn(labelled: DataFrame, settings: NetSettings) -> Net | None:
    """A network from rows (doc_id, text, lang), or None without any that has text and a language."""
    rows = labelled.where("text is not null and lang is not null and trim(text) <> '' and doc_id is not null")
    place = rows.withColumn("draw", F.xxhash64("doc_id")).withColumn("stratum", F.pmod("draw", F.lit(settings.strata)))
    common = place.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(settings.languages)
    first = place.join(F.broadcast(common.select("lang")), "lang").groupBy("lang", "stratum").agg(F.min("draw").alias("draw"))
    reach = F.greatest(F.length("text") - settings.window, F.lit(0)) + 1
    cuts = [
        F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(k)), reach.cast("long")) + 1).cast("int"), F.lit(settings.window))
        for k in range(settings.stretches)
    ]
    # At most languages * strata documents, in short stretches.
    some = place.join(F.broadcast(first), ["lang", "stratum", "draw"]).select("lang", F.array(*cuts).alias("cuts"))
    sample = sorted((r.lang, *r.cuts) for r in some.collect())
    if not sample:
        return None
    labels = sorted({r[0] for r in sample})
    flat = pa.array([cut for r in sample for cut in r[1:]], pa.string())
    targets = np.array([labels.index(r[0]) for r in sample for _ in r[1:]])
    stacked, owners = [], []
    for part in texts(flat):
        windows, rows_of, sizes = windows_of(part, settings.window)
        use = (sizes >= 20) | (np.diff(rows_of, prepend=-1) > 0)  # no short rests
        stacked.append(windows[use])
        owners.append(targets[part.first + rows_of[use]])
    return train(np.concatenate(stacked), np.concatenate(owners), labels, settings)


def predict(docs: DataFrame, net: Net | None, settings: NetSettings, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``, from its whole text.

    ``lang_pred`` is ``und`` and the score 0 where the text is null or has no letter, or nothing could be learned.
    The score is the probability of the language. Rows that repeat an id, or have none, get a row each; of equal
    probabilities the first language counts. Other columns do not matter; an empty table gives no rows.
    """
    step = max(1, (1 << 17) // settings.window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts(batch.column(1)):
                names = np.full(part.rows, UNKNOWN, object)
                score = np.zeros(part.rows)
                if net is not None:
                    total = np.zeros((part.rows, len(net.labels)))
                    windows, rows, sizes = windows_of(part, settings.window)
                    for a in range(0, len(windows), step):
                        p = net.probabilities(windows[a : a + step]) * sizes[a : a + step, None]
                        for j in range(len(net.labels)):
                            total[:, j] += np.bincount(rows[a : a + step], p[:, j], part.rows)
                    known = _has_letter(part)
                    best = total.argmax(axis=1)
                    whole = np.maximum(total.sum(axis=1), 1e-9)
                    names[known] = np.array(net.labels, object)[best[known]]
                    score[known] = np.clip(total[np.arange(part.rows), best] / whole, 0, 1)[known]
                ids = batch.column(0).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(names.tolist(), pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(
    docs: DataFrame,
    learn_from: Column,
    settings: NetSettings = NetSettings(),
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Learns from the rows that meet ``learn_from`` (a condition on ``doc_id``), and predicts all rows."""
    labelled = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"), docs[lang].cast("string").alias("lang"))
    net = learn(labelled.where(F.coalesce(learn_from, F.lit(False))), settings)
    return predict(docs, net, settings, id, text)
