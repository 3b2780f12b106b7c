import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import simple8b
from tidewatch.llm.queries import QUERIES, word_tokenizer
from tidewatch.llm.textbytes import texts
from tidewatch.llm.token_files import WordEncoder, read_tokens, tokenize, write_tokens


@pytest.mark.parametrize("n", [0, 1, 3, 127, 128, 129, 5000])
@pytest.mark.parametrize("high", [1, 2, 300, 32766, 32767, 32768, 50000, 1 << 32])
def test_coding_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    data = simple8b.encode(ids)
    assert (simple8b.decode(data) == ids).all()
    if high <= 2 and n == 5000:
        assert len(data) < n / 4


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(spark):
    words = WordEncoder(word_tokenizer())
    sample = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    odd = [
        None, "", " \n\t ", "can't won't 'tis it's,", "A<|endoftext|>b <|ENDOFTEXT|> x<|startoftext|>,", "É. é, ×. ÷, ñ;", "é. É,",
        "x y z", "İI ß ΑΣ ας σ. 你好，世界。 12 3.4 a1b2", "...!!! ?a? -b- (c) [d]", "𝒳 👍🏽, ok", "a\x00b\x1fc \x85d", "“q” ‘r’",
    ]
    column = pa.array([*odd, *sample], pa.string())
    ids, counts = [], []
    for part in texts(column, 5000):
        some, n = words.encode(part)
        ids.append(some)
        counts.append(n)
    cuts = np.cumsum(np.concatenate(counts))
    pieces = np.split(np.concatenate(ids), cuts[:-1])
    for text, got in zip([*odd, *sample], pieces, strict=True):
        assert got.tolist() == plain(words.tokenizer, text), text


def test_query_matches_plain_encoding(spark):
    folder = "/root/testdata/sf0.001"
    tokenizer = WordEncoder(word_tokenizer()).tokenizer
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op7_token_files"](spark, folder).orderBy("doc_id").collect()
    start = 0
    for doc, row in zip(docs, got, strict=True):
        ids = np.array([*plain(tokenizer, doc.text), 1], "<u4")
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_odd_rows_and_reading_back(spark, tmp_path):
    rows = [(3, "b a", 1), (3, "a", 1), (None, None, 1), (1, "", 1), (2, "word " * 300_000, 1), (3, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(4)
    write_tokens(docs, f"{tmp_path}/t", word_tokenizer())
    got = read_tokens(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert [(r.doc_id, len(r.ids)) for r in got] == [(None, 1), (1, 1), (2, 300_001), (3, 2), (3, 2), (3, 3)]
    assert [r.start for r in got] == [0, 1, 2, 300_003, 300_005, 300_007] and all(r.ids[-1] == 1 for r in got)
    assert tokenize(docs.limit(0), word_tokenizer()).count() == 0
    assert tokenize(docs, word_tokenizer()).agg(F.sum("n_tokens")).first()[0] == 300_010
