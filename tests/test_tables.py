"""Loading, checks, sources and sinks."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import event, frame
from tidewatch import schemas as S
from tidewatch.operators import detectors, enrich, loading, quality, stats
from tidewatch.plans.batch import rebuild_results
from tidewatch.sinks.messages import each_of, to_text
from tidewatch.sinks.tables import (
    append_alerts,
    compact_alerts,
    compact_stats,
    create_or_truncate,
    folders,
    is_there,
    read_alerts,
    read_newest_stats,
    read_stats,
    upsert_stats,
)
from tidewatch.sources.kafka import kafka_options
from tidewatch.sources.tables import RefreshedTable, read_table
from tidewatch.streaming.facts import check_facts, read_facts, read_rejects, start_fact_load, store_facts
from tidewatch.streaming.jobs import enriching

NOON = datetime(2024, 1, 1, 12)
FACT = "transaction_id string, user_id string, product_id string, category string, amount double, event_time timestamp, seq long"


@pytest.fixture(scope="module")
def dimensions(spark):
    users = spark.createDataFrame([("u1", "Ann", "10.0.0.1"), ("u2", "Bob", None)], "user_id string, user_name string, ip_address string")
    products = spark.createDataFrame([("p1", "Pen")], "product_id string, product_name string")
    categories = spark.createDataFrame([("c1", None)], "category string, description string")
    return users, products, categories


def facts(spark, *rows):
    return spark.createDataFrame(rows, FACT)


def test_facts_are_taken_one_by_one(spark, dimensions):
    stored = spark.createDataFrame([("t9",)], "transaction_id string")
    checked = loading.check_references(
        facts(
            spark,
            ("t1", "nobody", "p1", "c1", 1.0, NOON, 0),  # the id stays free
            ("t1", "u1", "p1", "c1", 2.0, NOON, 1),
            ("t1", "u1", "p1", "c1", 3.0, NOON, 2),
            ("t2", "u1", None, "c1", 4.0, NOON, 3),  # no product is allowed
            ("t3", "u1", "px", "c1", 5.0, NOON, 4),
            ("t4", "u1", "p1", "cx", 6.0, NOON, 5),
            ("t5", None, "p1", "c1", 7.0, NOON, 6),
            ("t6", "u1", "p1", "c1", None, NOON, 7),
            ("t9", "u1", "p1", "c1", 8.0, NOON, 8),
        ),
        *dimensions,
    )
    tagged = loading.tagged_facts(checked, stored)
    assert {r.seq: r.reason for r in loading.rejected_facts(tagged).collect()} == {
        0: "no such user_id",
        2: "duplicate transaction_id",
        4: "no such product_id",
        5: "no such category",
        6: "user_id is null",
        7: "amount is null",
        8: "duplicate transaction_id",
    }
    taken = loading.accepted_facts(tagged).orderBy("transaction_id").collect()
    assert [(r.transaction_id, r.amount, r.transaction_type, r.result) for r in taken] == [
        ("t1", Decimal("2.00"), "purchase", "success"),
        ("t2", Decimal("4.00"), "purchase", "success"),
    ]


def test_insert_ignore_takes_the_first_of_a_key(spark):
    rows = spark.createDataFrame([("a", "2", 2), ("a", "1", 1), ("b", "3", 3)], "category string, description string, seq int")
    stored = spark.createDataFrame([("b", "old")], "category string, description string")
    new = loading.insert_ignore(rows, stored, S.CATEGORIES, "seq").collect()
    assert [tuple(r) for r in new] == [("a", "1")]


def test_enrichment_defaults(spark, dimensions):
    users, products, _ = dimensions
    rows = facts(
        spark,
        ("t1", "u1", "p1", "c1", 1.0, NOON, 0),
        ("t2", "u2", None, "c1", 1.0, NOON, 1),
        ("t3", "u3", "p3", "c1", 1.0, NOON, 2),
    )
    found = enrich.enrich_transactions(rows, users, products).orderBy("seq").collect()
    assert [(r.ip_address, r.product_name) for r in found] == [
        ("10.0.0.1", "Pen"), (None, "unknown"), ("0.0.0.0", "unknown"),
    ]


def test_quality_reports(spark, dimensions):
    rows = facts(
        spark,
        ("t1", "u1", "p1", "c1", 1.0, NOON, 0),
        ("t1", "ux", "px", "c1", 1.0, NOON, 1),
        (None, "ux", None, "c2", None, NOON, 2),
    )
    users, products, _ = dimensions
    assert [tuple(r) for r in quality.duplicate_keys(rows, ("transaction_id",)).collect()] == [("t1", 2)]
    nulls = {r.column_name: r.null_count for r in quality.null_counts(rows, ("transaction_id", "user_id", "amount")).collect()}
    assert nulls == {"transaction_id": 1, "user_id": 0, "amount": 1}
    assert [tuple(r) for r in quality.orphan_report(rows, "user_id", users).collect()] == [("user_id", "ux", 2)]
    assert [tuple(r) for r in quality.outside_domain(rows, "category", ("c1",)).collect()] == [("category", "c2", 1)]
    to_user, to_product, to_category = S.TRANSACTIONS.foreign_keys
    assert quality.remove_orphans(rows, to_user, users).count() == 1
    kept = quality.remove_orphans(rows, to_product, products).orderBy("seq").collect()
    assert [r.product_id for r in kept] == ["p1", None, None]
    with pytest.raises(Exception, match="no categories row for category c2"):
        quality.remove_orphans(rows, to_category, dimensions[2]).collect()
    table = loading.with_defaults(rows, S.TRANSACTIONS)
    reports = quality.check_table(table, S.TRANSACTIONS, S.DOMAINS["transactions"])
    assert set(reports) == {"null_counts", "duplicate_keys", "domain_transaction_type", "domain_result"}
    assert reports["domain_result"].count() == 0


def test_tables_are_created_then_emptied(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path}/shop'")
    tables = {"categories": S.CATEGORIES, "users": S.USERS}
    assert create_or_truncate(spark, "shop", tables) == "created"
    spark.createDataFrame([("c", None)], S.CATEGORIES.schema).write.insertInto("shop.categories")
    assert read_table(spark, "shop.categories", ("category",)).collect() == [("c",)]
    assert create_or_truncate(spark, "shop", tables) == "truncated"
    assert spark.table("shop.categories").count() == 0
    assert spark.table("shop.users").columns == S.USERS.schema.fieldNames()
    spark.sql("DROP DATABASE shop CASCADE")


def test_read_table_from_files(spark, tmp_path):
    spark.range(3).selectExpr("id", "id * 2 AS twice").write.parquet(f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t", ("twice",), format="parquet").columns == ["twice"]
    assert is_there(spark, f"{tmp_path}/t") and not is_there(spark, f"{tmp_path}/none")


def test_dimension_is_read_anew(spark, tmp_path):
    path, loads, snapshots = f"{tmp_path}/d", [], []

    def load():
        loads.append(1)
        return spark.read.parquet(path)

    spark.range(1).write.parquet(path)
    table = RefreshedTable(load, every=2, on_refresh=lambda df: snapshots.append(df.count()))
    assert table.at(0).count() == 1
    spark.range(5).write.mode("append").parquet(path)
    assert table.at(1).count() == 1 and len(loads) == 1
    assert table.at(2).count() == 6 and snapshots == [1, 6]


def test_stream_of_facts_is_enriched_with_fresh_dimensions(spark, dimensions, tmp_path):
    users, products, _ = dimensions
    users.write.parquet(f"{tmp_path}/users")
    write = enriching(
        RefreshedTable(lambda: spark.read.parquet(f"{tmp_path}/users"), every=1),
        RefreshedTable(lambda: products),
        to_text(f"{tmp_path}/out", lambda df: df),
    )
    batch = facts(spark, ("t1", "u9", "p1", "c1", 1.0, NOON, 0)).withColumns(
        {"transaction_type": F.lit("purchase"), "result": F.lit("success")}
    )
    write(batch, 0)
    spark.createDataFrame([("u9", "New", "9.9.9.9")], users.schema).write.mode("append").parquet(f"{tmp_path}/users")
    write(batch, 1)
    texts = [spark.read.text(f"{tmp_path}/out/batch_id={i}").first().value for i in (0, 1)]
    assert '"ip_address":"0.0.0.0"' in texts[0] and '"ip_address":"9.9.9.9"' in texts[1]


def test_compacted_stats_read_the_same(spark, tmp_path):
    log, target = f"{tmp_path}/log", f"{tmp_path}/compact"
    for batch, amount in enumerate((1.0, 2.0)):
        upsert_stats(log, "a")(stats.category_totals(frame(spark, [event(amount=amount)])), batch)
    compact_stats(spark, log, target)
    assert read_stats(spark, target).collect() == read_stats(spark, log).collect()
    upsert_stats(target, "b")(stats.category_totals(frame(spark, [event(amount=3.0)])), 0)
    assert [r.total_amount for r in read_stats(spark, target).collect()] == [3]


def test_rebuilt_results_are_read_by_folder(spark, tmp_path):
    rows = [event(user="a", ms=i, seq=i, amount=6000) for i in range(6)]
    rebuild_results(frame(spark, rows), f"{tmp_path}/alerts", f"{tmp_path}/stats")
    assert read_alerts(spark, f"{tmp_path}/alerts").where("alert_type = 'HIGH_FREQUENCY'").count() == 2
    assert spark.read.parquet(f"{tmp_path}/stats").where("category = 'ALL'").first().transaction_count == 6


def test_each_of_writes_to_all(spark):
    seen = []
    write = each_of(lambda df, n: seen.append(("a", n, df.count())), lambda df, n: seen.append(("b", n, df.count())))
    write(spark.range(3), 7)
    assert seen == [("a", 7, 3), ("b", 7, 3)]


def test_kafka_options():
    assert kafka_options("h:1", ("a", "b"), group_id="g", per_trigger=5) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "5",
    }


def load_runs(spark, dimensions, root, batches):
    """One run of the load per batch of facts."""
    tables = [RefreshedTable(lambda d=d: d) for d in dimensions]
    for number, rows in enumerate(batches):
        rows.coalesce(1).write.parquet(f"{root}/in/{number}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in/*")
        start_fact_load(stream, f"{root}/out", *tables, trigger={"availableNow": True})


def test_facts_of_a_stream_are_taken_once(spark, dimensions, tmp_path):
    batches = [
        facts(spark, ("t1", "u1", "p1", "c1", 1.0, NOON, 0), ("t2", "ux", "p1", "c1", 1.0, NOON, 1), ("t1", "u1", "p1", "c1", 5.0, NOON, 2)),
        facts(spark, ("t1", "u1", "p1", "c1", 9.0, NOON, 3), ("t2", "u1", "p1", "c1", 2.0, NOON, 4), ("t3", "u1", "p1", "c1", 3.0, NOON, 5)),
        facts(spark, ("t3", "u1", "p1", "c1", 7.0, NOON, 6), ("t3", "u1", "p1", "c1", 8.0, NOON, 7)),
    ]
    load_runs(spark, dimensions, tmp_path, batches)
    stored = read_facts(spark, f"{tmp_path}/out").orderBy("transaction_id").collect()
    assert [(r.transaction_id, r.amount) for r in stored] == [("t1", 1), ("t2", 2), ("t3", 3)]
    rejects = read_rejects(spark, f"{tmp_path}/out").orderBy("seq").collect()
    again = "duplicate transaction_id"
    assert [(r.seq, r.reason) for r in rejects] == [(1, "no such user_id"), (2, again), (3, again), (6, again), (7, again)]


def test_repeated_batches_of_a_load(spark, dimensions, tmp_path):
    """A batch that is repeated after its folders were written leaves no row twice, in either step."""
    root, tables = f"{tmp_path}/out", [RefreshedTable(lambda d=d: d) for d in dimensions]
    first = facts(spark, ("t1", "u1", "p1", "c1", 1.0, NOON, 0), ("t2", "ux", "p1", "c1", 1.0, NOON, 1))
    second = facts(spark, ("t1", "u1", "p1", "c1", 9.0, NOON, 2), ("t2", "u1", "p1", "c1", 2.0, NOON, 3))
    seen = "transaction_id string, first bigint, last bigint"
    for _ in range(2):
        check_facts(root, *tables)(first, 0)
    for batch_id in (0, 1):  # the load is met twice, as its files were written twice
        store_facts(root)(spark.createDataFrame([("t1", 0, 0)], seen), batch_id)
    check_facts(root, *tables)(second, 1)
    for batch_id in (2, 2):
        store_facts(root)(spark.createDataFrame([("t1", 0, 1), ("t2", 1, 1)], seen), batch_id)
    store_facts(root)(spark.createDataFrame([], seen), 3)
    stored = read_facts(spark, root).orderBy("transaction_id").collect()
    assert [(r.transaction_id, r.amount) for r in stored] == [("t1", 1), ("t2", 2)]
    rejects = read_rejects(spark, root).orderBy("seq").collect()
    assert [(r.seq, r.reason) for r in rejects] == [(1, "no such user_id"), (2, "duplicate transaction_id")]


def test_a_load_reads_its_own_rows_only(spark, dimensions, tmp_path):
    """However much is stored, a trigger opens the files of its own loads, and writes files for its own days."""
    rows = [(f"t{k}", "u1", "p1", "c1", 1.0, NOON + timedelta(days=k % 5), k) for k in range(500)]
    load_runs(spark, dimensions, tmp_path, [facts(spark, *rows[:490]), facts(spark, *rows[480:])])
    assert read_facts(spark, f"{tmp_path}/out").count() == 500
    assert read_rejects(spark, f"{tmp_path}/out").count() == 10
    files = spark.read.parquet(f"{tmp_path}/out/facts").where("load = 1").select(F.input_file_name()).distinct().count()
    assert files <= 5


def test_newest_statistics_open_the_newest_days(spark, tmp_path):
    path = f"{tmp_path}/stats"
    day = 86_400_000
    for batch in range(6):
        rows = [event(ms=batch * 2 * day + k * 3_600_000, seq=k, amount=float(batch + 1)) for k in range(30)]
        upsert_stats(path, "a")(stats.window_totals(frame(spark, rows)), batch)
    days = sorted(folders(spark, path, "day="), reverse=True)
    assert len(days) >= 11
    newest = read_newest_stats(spark, path, 20)
    opened = {f.split("day=")[1].split("/")[0] for f in newest.inputFiles()}
    assert opened <= set(days[:4]) and newest.count() >= 20
    whole = read_stats(spark, path).orderBy(F.desc("window_start")).limit(20).collect()
    assert newest.orderBy(F.desc("window_start")).limit(20).collect() == whole
    assert read_newest_stats(spark, path, 10**6).count() == read_stats(spark, path).count() == 180
    none = read_newest_stats(spark, path, 5, "category = 'none'")
    assert none.count() == 0


def test_alerts_put_together_between_batches(spark, tmp_path):
    path = f"{tmp_path}/alerts"

    def append(detector, batch, amount):
        rows = frame(spark, [event(ms=batch * 1000 + k, seq=k, amount=amount) for k in range(3)])
        append_alerts(path, detector, "main")(detectors.large_amount(rows), batch)

    def check(n):
        rows = read_alerts(spark, path).collect()
        assert len(rows) == n == len({(r.amount, r.alert_time, r.transaction_id) for r in rows})

    append("a", 0, 6000.0), append("a", 1, 6000.0), append("b", 0, 7000.0)
    check(9)
    compact_alerts(spark, path)
    check(9)
    append("a", 1, 6000.0)  # repeated after it was taken
    append("a", 2, 6000.0), append("c", 0, 8000.0)
    check(15)
    compact_alerts(spark, path, clear=True)
    check(15)
    assert folders(spark, path, "detector=a/run=main/batch_id=") == ["2"]
    append("b", 1, 7000.0)
    compact_alerts(spark, path, clear=True)
    check(18)
    assert len(folders(spark, path, "_compacted/version=")) == 2
