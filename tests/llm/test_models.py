"""Language identification, masked language model, quality classifier: held-out accuracy, and odd rows."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.brute import lower, words
from tidewatch.llm import language_id, masked_lm
from tidewatch.llm.boosting import BoostSettings, fit
from tidewatch.llm.docstats import count
from tidewatch.llm.language_id import NetSettings, identify, windows_of
from tidewatch.llm.quality_classifier import ClassifierSettings, classify, learn, sample, scored, with_vectors
from tidewatch.llm.queries import QUERIES
from tidewatch.llm.textbytes import span_hashes, texts

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- language


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    found = QUERIES["op1_language_id"](spark, MEDIUM)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 150 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark):
    rows = [(i, ["the thing was", "der nicht und die"][i % 2] + f" {i} " * 3, ["en", "de"][i % 2], "x") for i in range(1, 80)]
    rows += [(200, None, "en", "x"), (201, "12 !? 34", "en", "x"), (202, "", None, "x"), (None, "der nicht und", None, "x")]
    rows += [(203, "nicht und die der " * 40_000, None, "x"), (203, "the thing was the", None, "x"), (204, "日本", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = identify(docs, F.col("doc_id") < 100, NetSettings(epochs=20)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.lang_pred)
    assert by[200] == by[201] == by[202] == {"und"} and by[None] == {"de"} and by[203] == {"de", "en"}
    assert by[204] <= {"de", "en"}
    assert identify(docs.limit(0), F.lit(True)).count() == 0
    assert {r.lang_pred for r in identify(docs, F.lit(False)).collect()} == {"und"}


def test_windows_cover_every_byte():
    column = pa.array(["abc", None, "", "é" * 50, "x" * 64], pa.string())
    (part,) = texts(column)
    windows, rows, sizes = windows_of(part, 32)
    assert np.bincount(rows, sizes, 5).tolist() == [3, 0, 0, 100, 64]
    assert bytes(windows[rows == 3].ravel()[windows[rows == 3].ravel() < 256].astype(np.uint8)) == ("é" * 50).encode()


def test_languages_equal_a_loop_over_windows_and_filters(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    settings = NetSettings(epochs=2, window=48)
    net = language_id.learn(docs, settings)
    some = docs.limit(12).collect()
    got = {r.doc_id: r for r in language_id.predict(docs, net, settings).collect()}
    for doc in some:
        data, total = (doc.text or "").encode(), np.zeros(len(net.labels))
        for at in range(0, len(data), settings.window):
            part = data[at : at + settings.window]
            seen = list(part) + [256] * (settings.window - len(part))
            pooled = np.full(net.filters.shape[1], -np.inf)
            for place in range(settings.window - net.widest + 1):
                window = np.concatenate([net.embed[b] for b in seen[place : place + net.widest]])
                pooled = np.maximum(pooled, window @ net.filters)
            logits = np.maximum(pooled + net.bias, 0) @ net.out + net.out_bias
            total += np.exp(logits) / np.exp(logits).sum() * len(part)
        if not any(c.isalpha() for c in doc.text or ""):
            assert got[doc.doc_id].lang_pred == "und"
            continue
        assert got[doc.doc_id].lang_pred == net.labels[int(total.argmax())]
        assert abs(got[doc.doc_id].score - total.max() / total.sum()) < 1e-4


# --- masked language model


def test_scores_equal_a_loop_over_the_tokens(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    settings = masked_lm.LmSettings(steps=40)
    model = masked_lm.learn(docs, settings)
    table = model.table()
    got = {r.doc_id: r for r in masked_lm.score(docs, model).collect()}

    def token(word):
        data = np.frombuffer(lower(word).encode(), np.uint8)
        one = span_hashes(data, np.array([0]), np.array([len(data)]))[0]
        at = np.searchsorted(model.words, one)
        if at < len(model.words) and model.words[at] == one:
            return at + 1
        end = span_hashes(data, np.array([max(0, len(data) - 2)]), np.array([len(data)]))[0]
        return 1 + len(model.words) + int(end % np.uint64(settings.buckets))

    for doc in docs.limit(30).collect():
        ids = [0, *[token(w) for w in words(doc.text)], 0]
        want = sum(float(table[a, c, b]) for a, b, c in zip(ids, ids[1:], ids[2:]))
        r = got[doc.doc_id]
        assert r.n_tokens == len(ids) - 2 and abs(r.log_prob - want) < 1e-6 * max(1, -want)
    assert np.allclose(np.exp(table.astype(float)).sum(axis=2), 1, atol=1e-4)


def test_counts_are_of_the_whole_corpus_and_training_lowers_the_loss(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    total = sum(len(words(r.text)) for r in docs.collect())
    settings = masked_lm.LmSettings()
    counted = masked_lm.word_counts(docs, settings).agg(F.sum("n")).first()[0]
    assert counted == total

    def loss(steps):
        model = masked_lm.learn(docs, masked_lm.LmSettings(steps=steps))
        return masked_lm.score(docs, model).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]

    assert loss(100) > loss(5) + 0.1 > -math.log(128)


def test_scores_of_odd_rows(spark):
    rows = [(1, None), (2, " \n"), (None, "a b"), (3, "a b"), (3, "a b"), (4, "w " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = masked_lm.learn(docs, masked_lm.LmSettings(steps=3))
    got = masked_lm.score(docs, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[1].n_tokens == by[2].n_tokens == 0 and by[1].log_prob == 0 and by[1].per_token is None
    assert by[None].log_prob == by[3].log_prob < 0 and by[4].n_tokens == 200_000
    empty = docs.limit(0)
    assert masked_lm.score(empty, masked_lm.learn(empty)).count() == 0


def test_words_of_a_bucket_are_told_apart(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = [r.text for r in docs.collect()]
    counted = {}
    for text in held:
        for word in words(lower(text)):
            counted[word] = counted.get(word, 0) + 1
    rare = next(w for w, n in sorted(counted.items()) if n == 1 and len(w) > 4)
    odd = [(1, rare), (2, "qqzz" + rare[-2:]), (3, None), (3, " "), (None, rare)]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)

    def bucket(word):
        data = np.frombuffer(word.encode(), np.uint8)
        at = np.array([0, max(0, len(data) - 2)])
        whole, end = (span_hashes(data, at[k : k + 1], np.array([len(data)]))[0] for k in (0, 1))
        return None if whole in model.classes.words else int(end % np.uint64(model.classes.buckets))

    scores = {}
    for sent in (1 << 18, 50):  # all words sent, and most of them joined
        model = masked_lm.learn_words(docs, masked_lm.LmSettings(steps=20, sent_words=sent))
        classes = [(r.doc_id, r.n_tokens, r.log_prob) for r in masked_lm.score(every, model.classes).collect()]
        got = [(r.doc_id, r.n_tokens, r.log_prob) for r in masked_lm.score_words(every, model).collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
        scores[sent] = sorted(got, key=key)
        assert len(got) == len(classes)
    for a, b in zip(*scores.values(), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * max(1, -a[2])

    sizes, kinds, at = {}, {}, {w: bucket(w) for w in counted}
    for w, n in counted.items():
        sizes[at[w]] = sizes.get(at[w], 0) + n
        kinds[at[w]] = kinds.get(at[w], 0) + 1
    by_id = {}
    for d, n, s in classes:
        by_id.setdefault((d, n), []).append(s)

    def extra(text):
        parts = [(counted.get(w, 0) + 0.5) / (sizes[b] + 0.5 * (kinds[b] + 1)) for w in words(lower(text)) if (b := at.get(w, bucket(w))) is not None]
        return sum(map(math.log, parts))

    want = {1: extra(rare), 2: extra(odd[1][1])}
    one = {d: s for d, n, s in scores[50] if n == 1}
    assert abs(one[1] - by_id[1, 1][0] - want[1]) < 1e-6 and abs(one[2] - by_id[2, 1][0] - want[2]) < 1e-6
    assert one[2] < one[1] - 1  # an invented word with a seen ending scores below a seen word
    assert one[None] == one[1]


# --- quality


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    got = QUERIES["op6_quality_classifier"](spark, MEDIUM)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def _plain_vector(text):
    """The statistics of one text, counted by a loop; of ASCII letters, digits and signs alone."""
    seen, found = words(text), {}
    lines = [x for x in (text or "").split("\n") if words(x)]
    for i in range(len(seen) - 7):
        found.setdefault(tuple(seen[i : i + 8]), []).append(i)
    repeated = {i + k for at in found.values() if len(at) > 1 for i in at for k in range(8)}
    chars = [c for w in seen for c in w]
    symbols = sum(c in "#*$%&|<>" for c in chars)
    digits = sum(c in "0123456789" for c in chars)
    upper = sum("A" <= c <= "Z" for c in chars)
    other = sum(32 < ord(c) < 127 and not (c.isalnum() or c in "#*$%&|<>") for c in chars)
    letters = len(chars) - symbols - digits - other
    spaces = sum(c in " \t\n\v\f\r" for c in text or "")
    n, m, k = max(len(seen), 1), max(len(chars), 1), max(len(lines), 1)
    return [
        math.log1p(len(seen)), len(chars) / n, symbols / m, upper / max(letters, 1), other / m, digits / m, letters / m,
        len(set(seen)) / n, len(set(seen)) / math.sqrt(n), len(repeated) / n, (len(lines) - len(set(lines))) / k,
        len(seen) / k, spaces / n,
    ]


def test_quality_equals_a_loop_over_texts_and_trees(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", F.col("quality").cast("int").alias("label"))
    rows = with_vectors(docs)
    trees = learn(rows.join(labels, "doc_id"), ClassifierSettings(boost=BoostSettings(trees=12)))
    assert len(trees.feature)
    got = {r.doc_id: r.score for r in scored(rows, trees).collect()}
    seen = {r.doc_id: np.array(r.x) for r in rows.collect()}
    for doc in docs.collect():
        x = np.array(_plain_vector(doc.text))
        assert np.allclose(x, seen[doc.doc_id], rtol=1e-12)
        margin = trees.start
        for feature, limit, value in zip(trees.feature, trees.limit, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(seen[doc.doc_id][feature[node]] > limit[node])
            margin += value[node - len(feature)]
        assert abs(got[doc.doc_id] - 1 / (1 + math.exp(-margin))) < 1e-9


def test_the_sample_is_the_first_rows_by_hash(spark):
    rows = spark.range(5000).selectExpr("id div 2 as doc_id", "array(double(id)) as x", "int(id % 2) as label").repartition(9)
    every = [(r.doc_id, r.label) for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").collect()]
    for size in (0, 1, 777, 5000, 9000):
        got = sample(rows, size)
        assert got.columns == rows.columns
        assert [(r.doc_id, r.label) for r in got.collect()] == every[:size]
    assert sample(rows.limit(0), 5).count() == 0
    alike = rows.withColumn("doc_id", F.lit(7))
    assert sample(alike, 10).count() == 10


def test_quality_of_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "a b c", 1), (3, "a " * 200_000, 1), (4, "x", 1), (4, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (2, None), (9, 0), (None, 1)], "doc_id long, quality int")
    got = classify(docs, labels, F.lit(True)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in classify(docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert classify(docs.limit(0), labels, F.lit(True)).count() == 0


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = fit(x[:3000], y[:3000], BoostSettings(trees=60, depth=3))
    assert ((trees.probabilities(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    one = trees.margins(x[:1])[0]
    total = trees.start
    for feature, limit, value in zip(trees.feature, trees.limit, trees.value):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(x[0, feature[node]] > limit[node])
        total += value[node - len(feature)]
    assert abs(one - total) < 1e-9


def test_counts_do_not_depend_on_slices():
    column = pa.array(["A b\nA b\nc", None, "", "x y z " * 50, "é é\té"], pa.string())
    whole = [count(p) for p in texts(column)]
    cut = [count(p) for p in texts(column, 1)]
    for name in whole[0]:
        assert np.concatenate([c[name] for c in whole]).tolist() == np.concatenate([c[name] for c in cut]).tolist()
