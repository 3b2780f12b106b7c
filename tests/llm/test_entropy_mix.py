import random

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.entropy_mix import MixSettings, mix, remixed
from tidewatch.llm.queries import QUERIES


def shared(sizes, weights=(5, 2, 1), most=3):
    """Targets by source, sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=str) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def rows(spark, sizes, columns="doc_id long, source string, text string, size int, rate string"):
    data = [(i, s, None if n is None else " ".join(["w"] * n), 0, "x") for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(data, columns).repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_copies(spark, seed):
    rand = random.Random(seed)
    sizes = [(rand.choice(["a", "b", "b", "b", "c", "d", None, "é"]), int(rand.lognormvariate(4, 1))) for _ in range(900)]
    total = {}
    for s, n in sizes:
        total[s] = total.get(s, 0) + n
    want = shared(total)
    docs = rows(spark, sizes)
    got = mix(docs, keep=["doc_id", "source"]).select("doc.*", "size", "source_size", "target", "taken", "copies").collect()
    assert len(got) == 900
    taken = {}
    for r in got:
        assert r.size == sizes[r.doc_id][1] and r.source_size == total[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in total:
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 30
    again = mix(docs.repartition(2), keep=["doc_id"]).select("doc.doc_id", "copies").collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in got}


def test_rates_solve_the_dual(spark):
    """Rates are exponentials of one number per source, and meet the targets before they are rounded."""
    folder = "/root/testdata/sf0.01"
    got = mix(spark.read.parquet(f"{folder}/documents.parquet"), keep=["source"]).select("doc.source", "size", "rate", "target", "source_size")
    met = got.groupBy("source").agg(F.sum(F.col("rate") * F.col("size")).alias("words"), F.max("target").alias("target")).collect()
    assert all(abs(r.words - r.target) < 1e-5 * r.target for r in met)
    z = F.pow("size", F.lit(0.25))
    duals = got.where("size > 0 and rate < 3").groupBy("source").agg(F.stddev(F.log("rate") / z).alias("spread")).collect()
    assert all(r.spread < 1e-6 for r in duals)


def test_hot_cell_is_cut(spark):
    docs = rows(spark, [("a", 10)] * 3500 + [("b", 10)] * 100)
    got = mix(docs, MixSettings(cell_rows=100), keep=["source"]).groupBy("doc.source").agg(F.sum("taken"), F.max("target"), F.count("*")).collect()
    assert all(abs(r[1] - r[2]) <= 10 for r in got) and sorted(r[3] for r in got) == [100, 3500]


def test_query_stays_near_its_targets(spark):
    got = QUERIES["op10_entropy_mix"](spark, "/root/testdata/sf0.01")
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert got.where("taken > 3 * size").count() == 0


def test_odd_rows(spark):
    docs = rows(spark, [("a", None), ("a", 0), (None, 5), ("b", 0), ("c", 3000), ("c", 1)])
    repeated = docs.unionByName(docs.where("doc_id = 2"))
    assert mix(repeated).count() == 7
    assert mix(docs.limit(0)).count() == 0
    out = remixed(docs)
    assert out.columns == docs.columns and out.where("source = 'a' or source = 'b'").count() == 0
    assert mix(docs.where("source = 'b'")).select("taken", "target").collect()[0] == (0, 0.0)


@pytest.mark.parametrize("id", [7, None])
def test_many_equal_rows(spark, id):
    """Of 3,000 equal rows, which no id tells apart, none is lost, and all sources come near their targets."""
    data = [(id, 10, "a")] * 3000 + [(k, 10, "a") for k in range(100, 1700)]
    data += [(k, 7 + k % 3, "b") for k in range(1, 400)] + [(None, 4, "c")] * 1500 + [(5, 4, "c")] * 20 + [(3, 9, "b")] * 3
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, n, s in data], "doc_id long, text string, source string")
    for parts in (3, 7):
        got = mix(docs.repartition(parts), keep=["doc_id", "source"]).select("doc.*", "size", "taken", "target").collect()
        assert sorted((str(r.doc_id), r.size, r.source) for r in got) == sorted((str(i), n, s) for i, n, s in data)
        for s in "abc":
            mine = [r for r in got if r.source == s]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 10
        counts = sorted((str(r.doc_id), r.size, r.source, r.taken) for r in got)
        assert parts == 3 or counts == before
        before = counts
    assert remixed(docs).columns == docs.columns
