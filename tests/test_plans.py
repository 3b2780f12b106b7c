"""What the plans must look like: pruned scans, pushed filters, no pairwise joins, no Python per row."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from tests.compare import difference
from tidewatch.operators import detectors, reports, stats
from tidewatch.plans.queries import REGISTRY
from tidewatch.sinks.tables import read_stats, upsert_stats
from tidewatch.sources import star

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(detectors.large_amount(star.order_events(spark, FOLDER)))
    assert "GreaterThan(o_totalprice,5000.0)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan(stats.window_totals(star.events(spark, FOLDER)))
    text = plan(detectors.high_frequency(star.events(spark, FOLDER)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_history_range_reaches_the_stored_files(spark, tmp_path):
    upsert_stats(f"{tmp_path}/s", "a")(stats.category_totals(star.events(spark, FOLDER)), 0)
    text = plan(reports.stats_history(read_stats(spark, f"{tmp_path}/s"), "2024-01-02", "2024-01-03"))
    assert "GreaterThanOrEqual(window_start" in text and "TakeOrderedAndProject" in text


def test_stored_days_are_pruned(spark, tmp_path):
    upsert_stats(f"{tmp_path}/s", "a")(stats.category_totals(star.events(spark, FOLDER)), 0)
    text = plan(read_stats(spark, f"{tmp_path}/s", "2024-01-02", "2024-01-03"))
    assert "PartitionFilters: [isnotnull(day" in text


def test_totals_are_partial_before_the_shuffle(spark):
    text = plan(stats.window_totals(star.events(spark, FOLDER)))
    assert text.index("partial_sum") < text.index("hashpartitioning")
    assert "SortAggregate" not in plan(stats.category_totals(star.events(spark, FOLDER)))


@pytest.mark.parametrize("name", [n for n in REGISTRY if not n.startswith(("stream_", "stored_", "upsert_", "dimension_", "reload_"))])
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(REGISTRY[name].run(spark, FOLDER))
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "PythonUDF"):
        assert operator not in text


@pytest.mark.parametrize("name", ["window_stats", "continuous_increase", "load_facts", "alerts_by_type"])
def test_queries_equal_their_sql(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name], FOLDER) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
    assert REGISTRY.keys() <= entry.queries().keys() and REGISTRY.keys() <= entry.oracle_sql().keys()
