import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.queries import QUERIES
from tidewatch.llm.token_attribution import FIRST, LAST, MOST, attribute, joined_fields

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def brute(tokenizer, text, sections, rule):
    """Tokens per section, and crossing ones, with the offsets of another library."""
    counts, across = [0] * len(sections), [0] * len(sections)
    for a, b in tokenizer.encode(text, add_special_tokens=False).offsets:
        held = [min(b, e) - max(a, s) for s, e in sections]
        inside = [k for k, (s, e) in enumerate(sections) if a < e and b > s]
        if not inside:
            k = max([k for k, (s, e) in enumerate(sections) if s < b], default=0)
        elif rule == MOST:
            k = max(inside, key=lambda k: (held[k], -k))
        else:
            k = inside[0] if rule == FIRST else inside[-1]
        counts[k] += 1
        across[k] += len(inside) > 1
    return list(zip(counts, across, strict=True))


@pytest.fixture(scope="module")
def tokenizer():
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    return one


def test_sample_matches_offsets_of_another_library(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    got = {}
    for r in QUERIES["op4_token_attribution"](spark, folder).orderBy("doc_id", "section").collect():
        got.setdefault(r.doc_id, []).append(((r.start, r.end), (r.n_tokens, r.n_crossing)))
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        n = len(doc.text)
        sections = [(i, min(i + 1000, n)) for i in range(0, n, 1000)]
        want = list(zip(sections, brute(tokenizer, doc.text, sections, MOST), strict=True))
        assert got[doc.doc_id] == want


@pytest.mark.parametrize("rule", [FIRST, MOST, LAST])
def test_rules(spark, tokenizer, rule):
    text = "Größe straße naïve 日本語 don't\n\n  under-score 👍🏽 end   "
    sections = [(0, 3), (3, 8), (12, 20), (20, 22), (25, len(text) - 1)]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    cuts = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in sections])
    got = attribute(docs, RANKS, PATTERN, cuts, rule).orderBy("section").collect()
    assert [(r.n_tokens, r.n_crossing) for r in got] == brute(tokenizer, text, sections, rule)


def test_fields_lines_and_odd_rows(spark, tokenizer):
    rows = [(1, "Title here", None, 1), (None, None, "b\n\nc", 2), (2, "", "", 3), (2, "", "", 3), (3, "t", "w " * 200_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, title string, text string, section int")
    body, sections = joined_fields(docs, ["title", "text"])
    whole = docs.select("doc_id", body.alias("text"), sections.alias("cuts"))
    got = attribute(whole, RANKS, PATTERN, whole["cuts"]).collect()
    assert len(got) == 10 and sum(r.n_tokens for r in got if r.doc_id == 3) == len(tokenizer.encode("t\n" + "w " * 200_000).ids)
    lines = attribute(docs, RANKS, PATTERN).collect()
    assert sorted((r.section, r.start, r.end) for r in lines if r.doc_id is None) == [(0, 0, 1), (1, 2, 2), (2, 3, 4)]
    assert sum(r.n_tokens for r in lines if r.doc_id is None) == len(tokenizer.encode("b\n\nc").ids)
    assert [r.n_tokens for r in lines if r.doc_id in (1, 2)] == [0, 0, 0]
    assert attribute(docs.limit(0), RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError):
        attribute(docs, RANKS, PATTERN, rule="other")
