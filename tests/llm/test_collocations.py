import random
import re
from collections import Counter

import pytest

from tests.llm.brute import lower
from tidewatch.llm.collocations import collocations, dictionary, frequent
from tidewatch.llm.queries import QUERIES


def counted(rows):
    """{(lang, words): how often} and {lang: number of words}."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least=100, top=2000):
    f, n = counted(rows)
    candidates = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    covered = set()
    for (lang, w), c in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                if c >= f[lang, w[i : i + size]]:
                    covered.add((lang, w[i : i + size]))
    out = {}
    for (lang, w), a in candidates.items():
        if (lang, w) in covered:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((" ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    rows = []
    for lang, found in out.items():
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        rows += [(lang, i + 1, *r) for i, r in enumerate(found[:top])]
    return sorted(rows)


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = sorted(tuple(r) for r in QUERIES["op11_collocations"](spark, folder).collect())
    assert got == brute([(d.lang, d.text) for d in docs]) and len(got) > 50


def made(draw, n):
    vocabulary = ["a", "B", "b", "cé", "d", "É", "e-f", "你好"]
    marks = [" ", " ", " ", "  ", "\t", ", ", "\n", " . ", "!", "\r\n", "\x0b", " \x1f "]
    passage = " ".join(draw.choices(vocabulary, k=60))
    rows = []
    for _ in range(n):
        text = "".join(draw.choice(vocabulary) + draw.choice(marks) for _ in range(draw.choice([0, 1, 4, 5, 30, 300])))
        if draw.random() < 0.3:
            text += passage
        rows.append((draw.choice(["en", "en", "en", "de", None, "und"]), text))
    return rows


@pytest.mark.parametrize(("least", "top"), [(1, 10**6), (2, 10**6), (7, 50), (40, 3)])
def test_small_corpora(spark, least, top):
    rows = made(random.Random(least), 60)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = sorted(tuple(r) for r in collocations(docs, least=least, top=top).collect())
    assert got == brute(rows, least, top)


def test_each_phrase_is_counted_once(spark):
    """Also where every place is cut, none is, and in copies, of which the dictionary holds one."""
    rows = [("en", "x " * 3000), ("en", "x y z " * 500), ("de", " ".join(f"w{k}" for k in range(5000)))] * 3
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    chunks = dictionary(docs)
    f, n = counted(rows)
    assert {r.lang: r.n for r in chunks.groupBy("lang").agg({"times": "max"}).selectExpr("lang", "`max(times)` AS n").collect()}["de"] == 3
    assert chunks.selectExpr("sum(own * times)").first()[0] == sum(n.values())
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in frequent(chunks, least=3).collect()}
    assert got == {x: c for x, c in f.items() if c >= 3}


def test_odd_rows(spark):
    rows = [(None, None, 1), (None, "", 1), ("en", " .\n, ", 1), ("und", "a b " * 60, 1), (None, "a b " * 60, 1), (None, "a b " * 60, 1)]
    docs = spark.createDataFrame(rows, "lang string, text string, phrase int")
    got = sorted(tuple(r) for r in collocations(docs).collect())
    assert got == brute([(lang, text) for lang, text, _ in rows]) and got
    assert collocations(docs.limit(0)).count() == 0
    long = spark.createDataFrame([("en", "good old days " * 200_000)], "lang string, text string")
    assert [(r.phrase, r.a) for r in collocations(long).orderBy("rank").collect()] == [
        (r[2], r[3]) for r in brute([("en", "good old days " * 200_000)])
    ]
