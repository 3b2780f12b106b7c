import random

from tests.llm.brute import lower, words
from tidewatch.llm.decontamination import LeakSettings, keep_clean, leaks

DOC = "doc_id long, text string, item_id int, words string, hash long"
ITEM = "item_id long, text string, doc_id int"


def weights(run_words, n):
    out = {}
    for i in range(len(run_words) - n + 1):
        run = " ".join(run_words[i : i + n])
        out[run] = out.get(run, 0) + len(run)
    return out


def brute(docs, items, settings=LeakSettings()):
    """{(doc, item)} by trying every window of every document."""
    found = set()
    for d, text in docs:
        w = words(lower(text))
        for i, item in items:
            v = words(lower(item))
            n = min(len(v), settings.words)
            if not v:
                continue
            own = weights(v, n)
            for start in range(1 - len(v), len(w)):
                piece = w[max(start, 0) : start + len(v)]
                if len(piece) < n:
                    continue
                other = weights(piece, n)
                common = sum(min(x, own.get(r, 0)) for r, x in other.items())
                if common / (sum(own.values()) + sum(other.values()) - common) >= settings.similarity:
                    found.add((d, i))
                    break
    return found


def rows(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, 1, "x", 2) for d, t in docs], DOC).repartition(3),
        spark.createDataFrame([(i, t, 1) for i, t in items], ITEM),
    )


def test_planted_passages_match_all_windows(spark):
    rand = random.Random(2)
    vocab = [f"word{i}" for i in range(300)]
    say = lambda n: [rand.choice(vocab) for _ in range(n)]
    items = [(i, say(rand.choice([15, 20, 30, 45]))) for i in range(12)]
    docs = []
    for d in range(60):
        body = say(rand.randint(20, 150))
        if d % 2:
            _, passage = rand.choice(items)
            passage = list(passage)
            for _ in range(rand.choice([0, 0, 1, 2])):
                passage[rand.randrange(len(passage))] = "other"
            at = rand.randint(0, len(body))
            body[at:at] = passage
        docs.append((d, " ".join(body).upper() if d % 5 == 0 else "\n".join([" ".join(body)])))
    items = [(i, " ".join(t)) for i, t in items] + [(90, "only three words"), (91, ""), (92, None)]
    docs += [(100, "say only three words here"), (101, "three only words")]
    want = brute(docs, items)
    got = leaks(*rows(spark, docs, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert (100, 90) in want and len(want) > 10


def test_moved_parts_match_all_windows(spark):
    rand = random.Random(5)
    vocab = [f"word{i}" for i in range(400)]
    say = lambda n: [rand.choice(vocab) for _ in range(n)]
    items = [(i, say(rand.choice([40, 60, 61, 90]))) for i in range(8)]
    docs, swapped = [], set()
    for d in range(40):
        i, passage = items[d % 8]
        passage, half = list(passage), len(passage) // 2
        if d % 4 == 0:
            passage = passage[half:] + passage[:half]
            swapped.add((d, i))
        elif d % 4 == 1:
            for _ in range(rand.randint(1, 4)):
                passage.insert(rand.randrange(len(passage)), "more")
        elif d % 4 == 2:
            at = rand.randrange(len(passage) - 6)
            del passage[at : at + rand.randint(1, 6)]
        else:
            passage = passage[2 * half // 3 :] + passage[: 2 * half // 3] + passage[:half]
        body = say(rand.choice([0, 30, 100]))
        at = rand.randint(0, len(body))
        body[at:at] = passage
        docs.append((d, " ".join(body)))
    items = [(i, " ".join(t)) for i, t in items]
    want = brute(docs, items)
    got = leaks(*rows(spark, docs, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert len(swapped & want) >= 5 and len(want) > 15


def test_odd_rows(spark):
    item = " ".join(f"q{i}" for i in range(20))
    long = " ".join(f"z{i}" for i in range(100_000)) + " " + item
    docs = [(1, None), (2, ""), (None, item), (3, item), (3, item), (4, long), (5, "nothing of it")]
    docs, items = rows(spark, docs, [(1, item), (2, item)])
    found = sorted(((r.doc_id, r.item_id, r.start_word) for r in leaks(docs, items).collect()), key=str)
    want = [(3, 1, 0), (3, 2, 0)] * 2 + [(4, 1, 100_000), (4, 2, 100_000), (None, 1, 0), (None, 2, 0)]
    assert found == sorted(want, key=str)
    kept = keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0
    assert keep_clean(docs, items.limit(0)).count() == 7
