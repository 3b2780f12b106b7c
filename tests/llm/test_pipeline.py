import random
import zlib

import numpy as np

import corpus_pipeline
from tests.llm.brute import base_counts, linked
from tests.llm.test_decontamination import brute as leaking
from tidewatch.llm.queries import word_tokenizer
from tidewatch.llm.token_files import WordEncoder
from tidewatch.session import durable

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, FOLDER), f"test-{name}")
        kept.append(docs)
    everything = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    good, alone, clean, mixed, tokens = (d.collect() for d in kept)
    for stage in kept[:4]:
        assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    assert len({r.doc_id for r in good}) == len(good) > 100
    for r in good:
        counts = base_counts(r.text)
        assert r == everything[r.doc_id] and counts["n_words"] >= 20
        assert 100 * counts["n_repeat_words"] <= 30 * counts["n_words"]
    groups = linked([(r.doc_id, r.text) for r in good])
    assert {r.doc_id for r in alone} == set(groups.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {d for d, _ in leaking([(r.doc_id, r.text) for r in alone], items)}
    assert {r.doc_id for r in clean} == {r.doc_id for r in alone} - held
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean}
    tokenizer = WordEncoder(word_tokenizer()).tokenizer
    start = 0
    ordered = sorted(mixed, key=lambda r: r.doc_id)
    for doc, row in zip(ordered, sorted(tokens, key=lambda r: r.start), strict=True):
        ids = np.array([*tokenizer.encode(doc.text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_odd_documents(spark, tmp_path):
    """Nulls in any column, empty texts, repeated rows and ids, and columns named like those of the stages."""
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    draw = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    text = lambda n: " ".join(draw.choices(words, k=n))
    same, other = text(60), text(50)
    rows = [(k, text(draw.randint(25, 90)), draw.choice(["en", "de", None]), draw.choice(["a", "a", "b", None])) for k in range(60)]
    rows += [(100, same, "en", "a")] * 40 + [(101, same, "en", "b")] * 3 + [(100, other, "en", "a")] * 2
    rows += [(None, other, "de", "a"), (None, None, None, None), (200, None, "en", "a"), (201, "", "en", "b"), (202, " \n", None, None)]
    names = "doc_id long, text string, lang string, source string, gone long, doc string, size int, key int, part string"
    docs = spark.createDataFrame([(*r, r[0], "x", 1, None, "p") for r in rows], names).repartition(4)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, str(tmp_path)), f"odd-{name}")
        kept[name] = docs.collect()
        assert name == "token_files" or docs.columns == [c.split()[0] for c in names.split(", ")]
    good = [r for r in rows if len((r[1] or "").split()) >= 20]
    assert sorted(str((r.doc_id, r.text)) for r in kept["quality_rules"]) == sorted(str(r[:2]) for r in good)
    alone = [(r.doc_id, r.text) for r in kept["near_duplicates"]]
    assert alone.count((100, same)) == 1 and (101, same) not in alone and {(100, other), (None, other)} <= set(alone)
    assert {r[0] for r in rows[:60]} <= {d for d, _ in alone} and len(alone) == 63
    assert sorted(map(str, alone)) == sorted(str((r.doc_id, r.text)) for r in kept["benchmark_passages"])
    assert {(r.doc_id, r.text) for r in kept["mixture"]} <= set(alone)
    assert len(kept["token_files"]) == len(kept["mixture"]) > 40
