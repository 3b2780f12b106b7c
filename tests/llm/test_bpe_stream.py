import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidewatch.llm.bpe_stream import Decoder, Encoder, Merges, Transducer, decode, encode, round_trips
from tidewatch.llm.queries import QUERIES, word_tokenizer
from tidewatch.llm.textbytes import texts

ODD = [
    None, "", " \n\t ", "can't won't 'tis it's,", "A<|endoftext|>b <|ENDOFTEXT|> x<|startoftext|>,<|endoftext|><|endoftext|>", "É. é, ×. ÷, ñ;",
    "x y z", "İI ß ΑΣ ας σ. 你好，世界。 12 3.4 a1b2", "...!!! ?a? -b- (c) [d]", "𝒳 👍🏽, ok", "a\x00b\x1fc \x85d\x7f", "“q” ‘r’", "K Å ﬁ é ''s ''", "A" * 700 + "b",
]


def merged(word, merges, ends):
    """Lowest rank first, leftmost first."""
    symbols = [*word[:-1], word[-1] + ends] if word else []
    rank = {pair: k for k, pair in enumerate(merges)}
    while True:
        found = [(rank[pair], i) for i, pair in enumerate(itertools.pairwise(symbols)) if pair in rank]
        if not found:
            return symbols
        i = min(found)[1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def some_merges(seed):
    """A random list over two or three symbols in which no token is used before it is made."""
    draw = random.Random(seed)
    ends = draw.choice(["", "$"])
    letters = "abc"[: draw.choice([2, 2, 3])]
    tokens, merges = [*letters, *([s + ends for s in letters] if ends else [])], []
    for _ in range(draw.randint(1, 14)):
        left = draw.choice([t for t in tokens if not ends or not t.endswith(ends)])
        right = draw.choice(tokens)
        token = left + right
        if token not in tokens and len(token) < 9:
            merges.append((left, right))
            tokens.append(token)
    return letters, ends, merges


@pytest.mark.parametrize("seed", range(150))
def test_transducer_equals_merging_and_looks_ahead_far_enough(seed):
    letters, ends, merges = some_merges(seed)
    try:
        list_ = Merges(merges, ends)
    except ValueError:
        return
    draw = random.Random(seed)
    machine = Transducer(list_)
    for n in [1, 2, 3, 5, 8, 13, 40, 200, 600]:
        word = "".join(draw.choices(letters, k=n))
        if n >= 40 and draw.random() < 0.5:
            word = (word[: draw.randint(1, 5)] * n)[:n]
        out, place, widest = [], 0, 0
        while place < n:
            step = draw.randint(1, 9)
            out += machine.feed(word[place : place + step])
            place += step
            widest = max(widest, len(machine.text))
        assert widest <= machine.room + list_.lookahead
        assert out + machine.finish() == merged(word, merges, ends), (merges, word)

    # whatever follows, boundaries more than a lookahead back stay as they are
    def cuts(word):
        return list(itertools.accumulate(list_.size(t) for t in merged(word, merges, ends)))

    for _ in range(20):
        start = "".join(draw.choices(letters, k=list_.lookahead + 6))
        seen = set()
        for _ in range(12):
            rest = "".join(draw.choices(letters, k=draw.randint(1, 8)))
            seen.add(tuple(c for c in cuts(start + rest) if c < len(start) - list_.lookahead))
        assert len(seen) == 1


def test_lists_without_a_bound_are_refused():
    with pytest.raises(ValueError):
        Merges([("ab", "c"), ("a", "b")])
    with pytest.raises(ValueError):
        Merges([("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc")])


def test_texts_give_the_ids_of_the_library(spark):
    encoder, library = Encoder(word_tokenizer()), Tokenizer.from_file(word_tokenizer())
    sample = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    draw = random.Random(7)
    marks = "'<|>!., \ń 　ÉéßİΣσKÅ你好ﬁ👍🏽‍\x00\x1f\x7f0a9sStTaAaAzZ#$%^&*()"
    drawn = ["".join(draw.choices(marks, k=draw.randint(1, 40))) for _ in range(3000)]
    rows = [*ODD, *sample, *drawn]
    ids, counts = [], []
    for part in texts(pa.array(rows, pa.string()), 5000):
        some, n = encoder.encode_rows(part)
        ids.append(some)
        counts.append(n)
    pieces = np.split(np.concatenate(ids), np.cumsum(np.concatenate(counts))[:-1])
    for text, got in zip(rows, pieces, strict=True):
        assert got.tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_one_long_word_in_pieces():
    encoder, library = Encoder(word_tokenizer()), Tokenizer.from_file(word_tokenizer())
    draw = random.Random(3)
    lists = encoder.merges
    word = "".join(draw.choice("aeiounrtlsmjodq") for _ in range(30_000)) + "mojamojam" * 3000 + "a" * 20_000
    machine, out = Transducer(lists), []
    for begin in range(0, len(word), 777):
        out += machine.feed(word[begin : begin + 777])
        assert len(machine.text) <= machine.room + lists.lookahead and len(machine.last) <= len(machine.text) + 1
    assert len(out) > 20_000  # nearly all of it was certain before the end
    assert [encoder.ids[t] for t in out + machine.finish()] == library.encode(word, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_decoding_any_ids_in_pieces(name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    decoder, library = Decoder(path), Tokenizer.from_file(path)
    draw = np.random.default_rng(5)
    for n in [0, 1, 2, 5, 50, 2000]:
        for high in [256, 60_000]:  # single bytes are seldom UTF-8
            ids = draw.integers(0, high, n)
            want = library.decode(ids.tolist(), skip_special_tokens=False)
            assert "".join(decoder.decode(ids)) == want
            assert "".join([*(decoder.feed(ids[k : k + 1]) for k in range(n)), decoder.finish()]) == want


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    coded = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(coded).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_query_matches_the_library(spark):
    folder, library = "/root/testdata/sf0.001", Tokenizer.from_file(word_tokenizer())
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_bpe_stream"](spark, folder).collect()}
    assert got == {d.doc_id: digests(library, d.text) for d in docs}


def test_odd_rows(spark):
    library = Tokenizer.from_file(word_tokenizer())
    rows = [(k, t, 1, "x") for k, t in enumerate(ODD)] + [(None, None, 1, "x"), (3, ODD[3], 1, "x"), (9, "Word " * 300_000, 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string").repartition(3)
    got = sorted(map(str, round_trips(docs, word_tokenizer()).collect()))
    want = spark.createDataFrame(
        [(d, *digests(library, t)) for d, t, *_ in rows], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    assert got == sorted(map(str, want.collect()))
    assert round_trips(docs.limit(0), word_tokenizer()).count() == 0
    coded = encode(docs, word_tokenizer())
    back = {(r.doc_id, r.text) for r in decode(coded, word_tokenizer()).collect()}
    assert back == {(d, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for d, t, *_ in rows}
