"""Registered queries over the star-schema tables, each with its SQL where SQL can say it.

The sample events are sparse (one per user every few hours), so the windows here are hours where the
defaults are seconds; the rules are the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.functions import json_with
from tidewatch.operators import detectors, enrich, loading, quality, reports, stats
from tidewatch.operators.alerts import alert_rows
from tidewatch.operators.parse import good_events, parse, rejected_events
from tidewatch.plans.batch import all_alerts, rebuild_results
from tidewatch.session import configure, new_folder
from tidewatch.settings import RiskSettings
from tidewatch.sinks.messages import to_text
from tidewatch.sinks.tables import (
    compact_alerts,
    create_or_truncate,
    read_alerts,
    read_newest_stats,
    read_stats,
    upsert_stats,
    write_batches,
)
from tidewatch.sources import star
from tidewatch.sources.files import arrival_files, replay_arrivals, write_arrivals
from tidewatch.sources.tables import RefreshedTable
from tidewatch.streaming.facts import read_facts, start_fact_load
from tidewatch.streaming.jobs import RESULTS, enriching, start, start_results, watermarked

HOUR = 3600
SAMPLE = RiskSettings(
    large_amount=200.0,
    burst_window_ms=24 * HOUR * 1000,
    failed_window_seconds=HOUR,
    failed_count=5,
    shared_ip_window_seconds=HOUR,
    burst_idle_ms=0,  # replays end
)
SHORT_BURST = RiskSettings(burst_window_ms=6 * HOUR * 1000)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that every engine returns alike: no zones, no decimals, no arrays."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double")
        if isinstance(field.dataType, T.ArrayType):
            if isinstance(field.dataType.elementType, T.DoubleType):
                column = F.transform(column, lambda x: x.cast("decimal(18,2)").cast("string"))
            return F.array_join(column, ", ")
        return column

    return df.select(*[plain(f).alias(f.name) for f in df.schema.fields])


def register(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(run(configure(spark), folder))

        REGISTRY[name] = Query(prepared, sql)
        return run

    return add


# --- SQL building blocks -----------------------------------------------------------------------------

EV = """ev AS (
  SELECT 'user_' || user_id AS user_id, value AS amount, event_type AS category, epoch_us(ts) // 1000 AS t,
         'txn_' || event_id AS transaction_id, event_id AS seq,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS result,
         '10.0.' || (k // 10) || '.' || (k % 10 + 1) AS ip_address,
         'prod_' || k AS product_id, 'Product ' || k AS product_name
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
)"""
USERS = """users AS (
  SELECT 'user_' || c_custkey AS user_id, c_name AS user_name,
         '10.0.' || (c_custkey % 30 // 10) || '.' || (c_custkey % 10 + 1) AS ip_address,
         CASE WHEN c_acctbal >= 5000 THEN 'vip' ELSE 'normal' END AS account_type,
         c_mktsegment AS device
  FROM customer
)"""
# Arrival order inside one millisecond: all of the window, without the equals, plus those already there.
BURSTS = """{name} AS (
  SELECT * FROM (
    SELECT user_id, t, count(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN {ms} - 1 PRECEDING AND CURRENT ROW)
           - count(*) OVER (PARTITION BY user_id, t)
           + row_number() OVER (PARTITION BY user_id, t ORDER BY seq) AS n
    FROM ev) WHERE n >= 5
)"""
RUNS = """runs AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY t, seq) AS place FROM (
    SELECT *, sum(CASE WHEN grows THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY t, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM (
      SELECT user_id, transaction_id, t, seq, amount,
             lag(amount, 1) OVER w AS one, lag(amount, 2) OVER w AS two,
             coalesce(amount >= lag(amount) OVER w * CAST(1.1 AS DOUBLE), false) AS grows
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t, seq)))
)"""
LARGE_SQL = """SELECT 'LARGE_AMOUNT' AS alert_type, user_id, transaction_id, amount, category,
  CAST(NULL AS BIGINT) AS transaction_count, CAST(NULL AS INTEGER) AS sequence_length,
  CAST(NULL AS VARCHAR) AS amounts, CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS BIGINT) AS user_count,
  CAST(NULL AS TIMESTAMP) AS window_start,
  CAST(NULL AS TIMESTAMP) AS window_end, epoch_ms(t) AS alert_time,
  'Transaction ' || transaction_id || ' amount ' || CAST(amount AS VARCHAR) || ' exceeds {limit}' AS details
FROM {source} WHERE amount > {limit}"""
BURST_SQL = """SELECT 'HIGH_FREQUENCY' AS alert_type, user_id, CAST(NULL AS VARCHAR) AS transaction_id,
  CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS category, CAST(n AS BIGINT) AS transaction_count,
  CAST(NULL AS INTEGER) AS sequence_length, CAST(NULL AS VARCHAR) AS amounts, CAST(NULL AS VARCHAR) AS ip_address,
  CAST(NULL AS BIGINT) AS user_count,
  epoch_ms(t - {ms}) AS window_start, epoch_ms(t) AS window_end, epoch_ms(t) AS alert_time,
  'User ' || user_id || ' has ' || n || ' transactions in last {seconds} seconds' AS details
FROM {name}"""
GROWTH_SQL = """SELECT 'CONTINUOUS_INCREASE' AS alert_type, user_id, transaction_id, amount,
  CAST(NULL AS VARCHAR) AS category, CAST(NULL AS BIGINT) AS transaction_count,
  CAST(3 AS INTEGER) AS sequence_length,
  CAST(CAST(two AS DECIMAL(18,2)) AS VARCHAR) || ', ' || CAST(CAST(one AS DECIMAL(18,2)) AS VARCHAR)
    || ', ' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS amounts,
  CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS BIGINT) AS user_count,
  CAST(NULL AS TIMESTAMP) AS window_start, CAST(NULL AS TIMESTAMP) AS window_end, epoch_ms(t) AS alert_time,
  'User ' || user_id || ' has 3 consecutive increasing transactions' AS details
FROM runs WHERE place % 3 = 0"""
SURGE_SQL = """SELECT 'FAILED_SURGE' AS alert_type, 'GLOBAL' AS user_id, CAST(NULL AS VARCHAR) AS transaction_id,
  CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS category, CAST(n AS BIGINT) AS transaction_count,
  CAST(NULL AS INTEGER) AS sequence_length, CAST(NULL AS VARCHAR) AS amounts, CAST(NULL AS VARCHAR) AS ip_address,
  CAST(NULL AS BIGINT) AS user_count,
  epoch_ms(w) AS window_start, epoch_ms(w + 3600000) AS window_end, epoch_ms(w + 3600000) AS alert_time,
  n || ' failed transactions in last 3600s' AS details
FROM (SELECT t - t % 3600000 AS w, count(*) AS n FROM ev WHERE result = 'failed' GROUP BY 1)
WHERE n >= 5"""
SHARED = """shared AS (
  SELECT t - t % 3600000 AS w, ip_address, count(DISTINCT user_id) AS n, min(user_id) AS first_user
  FROM ev GROUP BY 1, 2 HAVING count(DISTINCT user_id) >= 3
)"""
SHARED_SQL = """SELECT 'IP_SHARING' AS alert_type, first_user AS user_id, CAST(NULL AS VARCHAR) AS transaction_id,
  CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS BIGINT) AS transaction_count,
  CAST(NULL AS INTEGER) AS sequence_length, CAST(NULL AS VARCHAR) AS amounts, ip_address,
  CAST(n AS BIGINT) AS user_count,
  epoch_ms(w) AS window_start, epoch_ms(w + 3600000) AS window_end, epoch_ms(w + 3600000) AS alert_time,
  'IP ' || ip_address || ' has ' || n || ' distinct users in 3600s' AS details
FROM shared"""
DAY_MS, SIX_HOURS_MS = 86_400_000, 21_600_000
DAY_BURSTS = BURSTS.format(name="bursts", ms=DAY_MS)
DAY_BURST_SQL = BURST_SQL.format(name="bursts", ms=DAY_MS, seconds=86_400)
ALERTS = f"""{EV}, {DAY_BURSTS}, {RUNS}, {SHARED}, alerts AS (
{LARGE_SQL.format(source="ev", limit="200.0")}
UNION ALL {DAY_BURST_SQL}
UNION ALL {GROWTH_SQL}
UNION ALL {SURGE_SQL}
UNION ALL {SHARED_SQL}
), alert_rows AS (
  SELECT alert_type, user_id, transaction_id, CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount,
         coalesce(transaction_count, user_count) AS transaction_count, window_start, window_end, details, alert_time
  FROM alerts
)"""
NEWEST = """ORDER BY alert_time DESC, alert_type, user_id, transaction_id NULLS FIRST,
  transaction_count NULLS FIRST, details"""
TOTALS = """CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  count(*) AS transaction_count"""
STATS = f"""stats AS (
  SELECT epoch_ms(t - t % 5000) AS window_start, epoch_ms(t - t % 5000 + 5000) AS window_end,
         CASE WHEN grouping(category) = 1 THEN 'ALL' ELSE category END AS category,
         {TOTALS}, grouping(category) = 1 AS is_total
  FROM ev GROUP BY GROUPING SETS ((t - t % 5000, category), (t - t % 5000))
)"""


def sample_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return all_alerts(star.events(spark, folder), SAMPLE)


def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return alert_rows(sample_alerts(spark, folder))


def sample_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.stats_rows(stats.window_stats(star.events(spark, folder)))


# --- parse -------------------------------------------------------------------------------------------


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The events as producers might send them: sign-ups say nothing of a category, clicks send null for it,
    views quote the amount, and errors have a word in its place."""
    e = star.events(spark, folder)
    kind, amount = F.col("category"), F.col("amount").cast("string")
    as_json = F.to_json(
        F.struct(
            "transaction_id",
            "user_id",
            "timestamp",
            "ip_address",
            F.when(kind.isin("purchase", "view"), kind).alias("category"),
        )
    )
    amount_text = (
        F.when(kind == "view", F.concat(F.lit('"'), amount, F.lit('"')))
        .when(kind == "error", F.lit('"none"'))
        .otherwise(amount)
    )
    members = F.concat(F.lit('"amount":'), amount_text), F.when(kind == "click", F.lit('"category":null'))
    return e.select(json_with(as_json, *members).alias("value"), "seq")


@register(
    "parse_events",
    f"""WITH {EV}
SELECT user_id, amount,
  CASE category WHEN 'signup' THEN 'unknown' WHEN 'click' THEN NULL ELSE category END AS category,
  t AS timestamp, transaction_id, 'success' AS result, 'purchase' AS transaction_type, ip_address,
  'unknown' AS product_id, 'unknown' AS product_name, epoch_ms(t) AS event_time, seq
FROM ev WHERE category <> 'error'""",
)
def parse_events_query(spark, folder):
    return good_events(parse(raw_messages(spark, folder), seq=F.col("seq")))


@register(
    "rejected_events",
    f"""WITH {EV}
SELECT '{{"transaction_id":"' || transaction_id || '","user_id":"' || user_id || '","timestamp":' || t
  || ',"ip_address":"' || ip_address || '","amount":"none"}}' AS value, 'bad amount' AS error
FROM ev WHERE category = 'error'""",
)
def rejected_events_query(spark, folder):
    return rejected_events(parse(raw_messages(spark, folder)))


# --- statistics --------------------------------------------------------------------------------------


@register("window_stats", f"WITH {EV}, {STATS} SELECT * FROM stats")
def window_stats_query(spark, folder):
    return stats.window_stats(star.events(spark, folder))


@register(
    "window_totals",
    f"""WITH {EV}
SELECT epoch_ms(t - t % 5000) AS window_start, epoch_ms(t - t % 5000 + 5000) AS window_end, {TOTALS}
FROM ev GROUP BY t - t % 5000""",
)
def window_totals_query(spark, folder):
    return stats.window_totals(star.events(spark, folder))


@register(
    "category_totals",
    f"""WITH {EV}
SELECT epoch_ms(t - t % 5000) AS window_start, epoch_ms(t - t % 5000 + 5000) AS window_end, category, {TOTALS}
FROM ev GROUP BY t - t % 5000, category""",
)
def category_totals_query(spark, folder):
    return stats.category_totals(star.events(spark, folder))


@register(
    "product_window_stats",
    f"""WITH {EV}
SELECT epoch_ms(t - t % 3600000) AS window_start, epoch_ms(t - t % 3600000 + 3600000) AS window_end,
  product_name, first(category ORDER BY t, seq) AS category, {TOTALS}
FROM ev GROUP BY t - t % 3600000, product_name""",
)
def product_window_stats_query(spark, folder):
    return stats.product_totals(star.events(spark, folder), RiskSettings(stats_window_seconds=HOUR))


@register("overall_totals", f"WITH {EV} SELECT {TOTALS} FROM ev")
def overall_totals_query(spark, folder):
    return stats.overall_totals(star.events(spark, folder))


@register(
    "running_totals",
    f"""WITH {EV}
SELECT transaction_id, t AS timestamp,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total_amount, count(*) OVER w AS transaction_count
FROM ev WINDOW w AS (ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_totals_query(spark, folder):
    return stats.running_totals(star.events(spark, folder))


# --- detectors ---------------------------------------------------------------------------------------

ORDER_EV = """ev AS (
  SELECT 'user_' || o_custkey AS user_id, o_totalprice AS amount, o_orderpriority AS category,
         epoch_us(o_orderdate) // 1000 AS t, 'txn_' || o_orderkey AS transaction_id, o_orderkey AS seq
  FROM orders
)"""


@register("large_amount", f"WITH {ORDER_EV} {LARGE_SQL.format(source='ev', limit='5000.0')}")
def large_amount_query(spark, folder):
    return detectors.large_amount(star.order_events(spark, folder))


@register("large_amount_events", f"WITH {EV} {LARGE_SQL.format(source='ev', limit='200.0')}")
def large_amount_events_query(spark, folder):
    return detectors.large_amount(star.events(spark, folder), SAMPLE)


@register("failed_surge", f"WITH {EV} {SURGE_SQL}")
def failed_surge_query(spark, folder):
    return detectors.failed_surge(star.events(spark, folder), SAMPLE)


@register("ip_sharing", f"WITH {EV}, {SHARED} {SHARED_SQL}")
def ip_sharing_query(spark, folder):
    return detectors.ip_sharing(star.events(spark, folder), SAMPLE)


@register(
    "ip_sharing_users",
    f"""WITH {EV} SELECT DISTINCT epoch_ms(t - t % 3600000) AS window_start,
  epoch_ms(t - t % 3600000 + 3600000) AS window_end, ip_address, user_id FROM ev""",
)
def ip_sharing_users_query(spark, folder):
    pairs = detectors.ip_sharing_users(star.events(spark, folder), SAMPLE)
    return pairs.selectExpr("window.start AS window_start", "window.end AS window_end", "ip_address", "user_id")


@register(
    "ip_sharing_members",
    f"""WITH {EV}, {SHARED}
SELECT DISTINCT epoch_ms(w) AS window_start, epoch_ms(w + 3600000) AS window_end, ev.ip_address, ev.user_id
FROM ev JOIN shared ON shared.w = t - t % 3600000 AND shared.ip_address = ev.ip_address""",
)
def ip_sharing_members_query(spark, folder):
    return detectors.ip_sharing_members(star.events(spark, folder), SAMPLE)


@register("high_frequency", f"WITH {EV}, {DAY_BURSTS} {DAY_BURST_SQL}")
def high_frequency_query(spark, folder):
    return detectors.high_frequency(star.events(spark, folder), SAMPLE)


@register(
    "high_frequency_short",
    f"WITH {EV}, {BURSTS.format(name='bursts', ms=SIX_HOURS_MS)} "
    + BURST_SQL.format(name="bursts", ms=SIX_HOURS_MS, seconds=21_600),
)
def high_frequency_short_query(spark, folder):
    return detectors.high_frequency(star.events(spark, folder), SHORT_BURST)


@register("continuous_increase", f"WITH {EV}, {RUNS} {GROWTH_SQL}")
def continuous_increase_query(spark, folder):
    return detectors.continuous_increase(star.events(spark, folder))


@register("all_alerts", f"WITH {ALERTS} SELECT * FROM alerts")
def all_alerts_query(spark, folder):
    return sample_alerts(spark, folder)


@register("risk_alert_rows", f"WITH {ALERTS} SELECT * FROM alert_rows")
def risk_alert_rows_query(spark, folder):
    return sample_rows(spark, folder)


# --- reports -----------------------------------------------------------------------------------------

TOP_KNOWN = """SELECT user_id, user_name, count(*) AS alert_count
FROM alert_rows JOIN users USING (user_id) GROUP BY 1, 2 ORDER BY alert_count DESC, user_id LIMIT {n}"""


@register("top_risky_users", f"WITH {ALERTS}, {USERS} {TOP_KNOWN.format(n=5)}")
def top_risky_users_query(spark, folder):
    return reports.top_risky_users(sample_rows(spark, folder), star.users(spark, folder))


@register(
    "top_risky_users_with_unknown",
    f"""WITH {ALERTS}, {USERS}, top AS (
  SELECT user_id, count(*) AS alert_count FROM alert_rows GROUP BY 1 ORDER BY alert_count DESC, user_id LIMIT 5)
SELECT top.user_id, coalesce(user_name, 'unknown') AS user_name, alert_count
FROM top LEFT JOIN users ON users.user_id = top.user_id""",
)
def top_risky_users_with_unknown_query(spark, folder):
    return reports.top_risky_users_with_unknown(sample_rows(spark, folder), star.users(spark, folder))


@register(
    "ranked_risky_users",
    f"""WITH {ALERTS}, {USERS}, top AS ({TOP_KNOWN.format(n=10)})
SELECT *, '#' || row_number() OVER (ORDER BY alert_count DESC, user_id) AS rank FROM top""",
)
def ranked_risky_users_query(spark, folder):
    return reports.ranked(
        reports.top_risky_users(sample_rows(spark, folder), star.users(spark, folder), limit=10)
    )


@register(
    "alerts_per_user",
    f"WITH {ALERTS} SELECT user_id, count(*) AS alert_count FROM alert_rows GROUP BY 1",
)
def alerts_per_user_query(spark, folder):
    return reports.alerts_per_user(sample_rows(spark, folder))


@register(
    "alerts_by_type", f'WITH {ALERTS} SELECT alert_type, count(*) AS "count" FROM alert_rows GROUP BY 1'
)
def alerts_by_type_query(spark, folder):
    return reports.alerts_by_type(sample_rows(spark, folder))


@register(
    "alerts_by_hour",
    f"""WITH {ALERTS}
SELECT strftime(alert_time, '%H:00') AS hour, count(*) AS "count" FROM alert_rows
WHERE alert_time >= TIMESTAMP '2024-01-20 12:30:00' - INTERVAL 24 HOURS GROUP BY 1""",
)
def alerts_by_hour_query(spark, folder):
    as_of = F.to_timestamp(F.lit("2024-01-20 12:30:00"))
    return reports.alerts_by_hour(sample_rows(spark, folder), as_of)


SEARCH = f"""SELECT alert_type, user_id, transaction_id, amount, transaction_count, details, alert_time
FROM alert_rows {{where}} {NEWEST} LIMIT {{n}}"""


@register("alert_search", f"WITH {ALERTS} {SEARCH.format(where='', n=500)}")
def alert_search_query(spark, folder):
    return reports.alert_search(sample_rows(spark, folder))


@register(
    "alert_search_by_type_and_keyword",
    f"WITH {ALERTS} "
    + SEARCH.format(
        where="""WHERE alert_type = 'HIGH_FREQUENCY' AND (user_id ILIKE '%USER_1_%'
  OR transaction_id ILIKE '%USER_1_%' OR details ILIKE '%USER_1_%')""",
        n=500,
    ),
)
def alert_search_by_type_and_keyword_query(spark, folder):
    return reports.alert_search(
        sample_rows(spark, folder), alert_type=S.HIGH_FREQUENCY, keyword="USER_1_"
    )


@register("alert_count", f"WITH {ALERTS} SELECT count(*) AS alert_count FROM alert_rows")
def alert_count_query(spark, folder):
    return reports.alert_count(sample_rows(spark, folder))


@register(
    "alert_feed",
    f"""WITH {ALERTS}, newest AS (SELECT * FROM alerts {NEWEST} LIMIT 200)
SELECT alert_time, alert_type, user_id, coalesce(nullif(transaction_id, ''), '-') AS transaction_id,
  coalesce(CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), CAST(nullif(transaction_count, 0) AS VARCHAR),
           CAST(nullif(user_count, 0) AS VARCHAR), '-') AS value, coalesce(details, '') AS details
FROM newest""",
)
def alert_feed_query(spark, folder):
    return reports.alert_feed(sample_alerts(spark, folder))


HISTORY = """SELECT window_start, window_end, category, total_amount, transaction_count FROM stats
{where} ORDER BY window_start DESC, window_end, category, total_amount, transaction_count LIMIT 200"""


@register("stats_history", f"WITH {EV}, {STATS} {HISTORY.format(where='')}")
def stats_history_query(spark, folder):
    return reports.stats_history(sample_stats(spark, folder))


@register(
    "stats_history_range",
    f"WITH {EV}, {STATS} "
    + HISTORY.format(
        where="""WHERE window_start >= TIMESTAMP '2024-01-10 00:00:00'
  AND window_end <= TIMESTAMP '2024-01-10 06:00:00'"""
    ),
)
def stats_history_range_query(spark, folder):
    return reports.stats_history(sample_stats(spark, folder), "2024-01-10 00:00:00", "2024-01-10 06:00:00")


@register(
    "recent_trend",
    f"""WITH {EV}, {STATS} SELECT window_start, total_amount, transaction_count FROM stats
WHERE category = 'ALL' ORDER BY window_start DESC LIMIT 60""",
)
def recent_trend_query(spark, folder):
    return reports.recent_trend(sample_stats(spark, folder))


@register(
    "latest_by_category",
    f"""WITH {EV}, {STATS}
SELECT category, max(window_start) AS window_start, arg_max(total_amount, window_start) AS total_amount,
  arg_max(transaction_count, window_start) AS transaction_count
FROM stats WHERE category <> 'ALL' GROUP BY category""",
)
def latest_by_category_query(spark, folder):
    return reports.latest_by_category(sample_stats(spark, folder))


@register(
    "category_list",
    "SELECT p_type AS category, count(*) || ' products' AS description FROM part GROUP BY p_type",
)
def category_list_query(spark, folder):
    return reports.category_list(star.categories(spark, folder))


# --- reports over stored results ----------------------------------------------------------------------


def stored_results(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both result tables, written by the batch job and read back."""
    root = new_folder(spark, "results")
    rebuild_results(star.events(spark, folder), f"{root}/alerts", f"{root}/stats", SAMPLE)
    return read_alerts(spark, f"{root}/alerts"), spark.read.parquet(f"{root}/stats").drop("day")


@register("stored_alert_search", f"WITH {ALERTS} {SEARCH.format(where='', n=500)}")
def stored_alert_search_query(spark, folder):
    return reports.alert_search(stored_results(spark, folder)[0])


@register("stored_top_risky_users", f"WITH {ALERTS}, {USERS} {TOP_KNOWN.format(n=5)}")
def stored_top_risky_users_query(spark, folder):
    return reports.top_risky_users(stored_results(spark, folder)[0], star.users(spark, folder))


@register("stored_stats_history", f"WITH {EV}, {STATS} {HISTORY.format(where='')}")
def stored_stats_history_query(spark, folder):
    return reports.stats_history(stored_results(spark, folder)[1])


# --- enrichment and messages -------------------------------------------------------------------------

# Suppliers are the users that are known; the events have users besides.
KNOWN = """known AS (
  SELECT 'user_' || s_suppkey AS user_id, '10.0.' || (s_suppkey % 30 // 10) || '.' || (s_suppkey % 10 + 1) AS ip_address
  FROM supplier
)"""
ENRICHED = f"""{EV}, {KNOWN}, enriched AS (
  SELECT ev.transaction_id, ev.user_id, ev.product_id, ev.category, ev.amount, 'purchase' AS transaction_type,
         ev.result, t, coalesce(known.ip_address, '0.0.0.0') AS ip_address, coalesce(p_name, 'unknown') AS product_name
  FROM ev LEFT JOIN known ON known.user_id = ev.user_id LEFT JOIN part ON 'prod_' || p_partkey = ev.product_id
)"""


def event_facts(spark: SparkSession, folder: str) -> DataFrame:
    columns = [f for f in S.TRANSACTIONS.schema.fieldNames() if f != "process_time"]
    return star.events(spark, folder).select(*columns)


def enriched_events(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enrich_transactions(
        event_facts(spark, folder), star.supplier_users(spark, folder), star.products(spark, folder)
    )


@register(
    "enrich_transactions",
    f"""WITH {ENRICHED}
SELECT transaction_id, user_id, product_id, category, amount, transaction_type, result, ip_address,
  product_name, epoch_ms(t) AS event_time FROM enriched""",
)
def enrich_transactions_query(spark, folder):
    return enriched_events(spark, folder)


@register(
    "event_messages",
    f"""WITH {ENRICHED}
SELECT '{{"transaction_id":"' || transaction_id || '","user_id":"' || user_id || '","product_id":"' || product_id
  || '","category":"' || category || '","amount":' || CAST(amount AS VARCHAR) || ',"transaction_type":"purchase"'
  || ',"result":"' || result || '","ip_address":"' || ip_address || '","product_name":"' || product_name
  || '","timestamp":' || t || '}}' AS value FROM enriched""",
)
def event_messages_query(spark, folder):
    facts = enriched_events(spark, folder)
    return enrich.event_messages(facts.withColumn("event_time", enrich.event_time_text()))


@register(
    "user_snapshot",
    f"""WITH {USERS}
SELECT user_id AS key, '{{"user_id":"' || user_id || '","user_name":"' || user_name || '","ip_address":"'
  || ip_address || '","account_type":"' || account_type || '","device":"' || device || '"}}' AS value
FROM users""",
)
def user_snapshot_query(spark, folder):
    return enrich.snapshot_messages(star.users(spark, folder))


@register(
    "category_messages",
    f"""WITH {EV}, {STATS}
SELECT '{{"window_start":' || epoch_ms(window_start) || ',"window_end":' || epoch_ms(window_end)
  || ',"category":"' || category || '","total_amount":' || CAST(total_amount AS VARCHAR)
  || ',"transaction_count":' || transaction_count || '}}' AS value
FROM stats WHERE NOT is_total""",
)
def category_messages_query(spark, folder):
    return enrich.stats_messages(stats.category_totals(star.events(spark, folder)))


@register(
    "result_feed",
    f"""WITH {EV}, {STATS}
SELECT '{{"topic":"alarm_events","data":{{"alert_type":"FAILED_SURGE","user_id":"GLOBAL","transaction_count":' || n
  || ',"window_start":"' || strftime(epoch_ms(w), '%Y-%m-%dT%H:%M:%S+00:00')
  || '","window_end":"' || strftime(epoch_ms(w + 3600000), '%Y-%m-%dT%H:%M:%S+00:00')
  || '","alert_time":"' || strftime(epoch_ms(w + 3600000), '%Y-%m-%dT%H:%M:%S+00:00')
  || '","details":"' || n || ' failed transactions in last 3600s"}}}}' AS value
FROM (SELECT t - t % 3600000 AS w, count(*) AS n FROM ev WHERE result = 'failed' GROUP BY 1) WHERE n >= 5
UNION ALL
SELECT '{{"topic":"window_count_and_amount_events","data":{{"window_start":' || epoch_ms(window_start)
  || ',"window_end":' || epoch_ms(window_end) || ',"total_amount":' || CAST(total_amount AS VARCHAR)
  || ',"transaction_count":' || transaction_count || '}}}}' AS value
FROM stats WHERE is_total""",
)
def result_feed_query(spark, folder):
    """Messages of two topics as one feed."""
    e = star.events(spark, folder)
    surges = enrich.alert_messages(detectors.failed_surge(e, SAMPLE))
    totals = enrich.stats_messages(stats.window_totals(e))
    topics = {S.ALERTS_TOPIC: surges, S.WINDOW_TOTALS_TOPIC: totals}
    messages = [df.select(F.lit(topic).alias("topic"), "value") for topic, df in topics.items()]
    return enrich.tagged_messages(reduce(DataFrame.unionByName, messages)).select("value")


# --- loading and quality -----------------------------------------------------------------------------

LINE_FACTS = f"""facts AS (
  SELECT 'txn_' || l_orderkey AS transaction_id, 'user_' || l_partkey AS user_id,
         'prod_' || l_partkey AS product_id, p_type AS category,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'refund' ELSE 'purchase' END AS transaction_type,
         CASE WHEN l_linestatus = 'O' THEN 'processing' ELSE 'success' END AS result,
         l_shipdate AS event_time, l_linenumber, l_partkey, l_suppkey
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
), stored AS (
  SELECT 'txn_' || event_id AS transaction_id FROM events
), reasons AS (
  SELECT facts.*, CASE WHEN c_custkey IS NULL THEN 'no such user_id' END AS reason
  FROM facts LEFT JOIN customer ON 'user_' || c_custkey = facts.user_id
), checked AS (
  SELECT reasons.* EXCLUDE (reason), coalesce(reason, CASE WHEN stored.transaction_id IS NOT NULL OR
      row_number() OVER (PARTITION BY reasons.transaction_id, reason
                   ORDER BY l_linenumber, l_partkey, l_suppkey, amount, event_time) > 1
    THEN 'duplicate transaction_id' END) AS reason
  FROM reasons LEFT JOIN stored ON stored.transaction_id = reasons.transaction_id
)"""


def checked_lines(spark: SparkSession, folder: str) -> DataFrame:
    return loading.check_references(
        star.line_facts(spark, folder),
        star.users(spark, folder),
        star.products(spark, folder),
        star.categories(spark, folder),
    )


def tagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines loaded into a fact table that holds the events."""
    return loading.tagged_facts(checked_lines(spark, folder), event_facts(spark, folder))


@register(
    "load_facts",
    f"""WITH {LINE_FACTS}
SELECT transaction_id, user_id, product_id, category, CAST(amount AS DOUBLE) AS amount, transaction_type,
  result, event_time FROM checked WHERE reason IS NULL""",
)
def load_facts_query(spark, folder):
    return loading.accepted_facts(tagged_lines(spark, folder)).drop("process_time")


@register(
    "rejected_facts",
    f"""WITH {LINE_FACTS}
SELECT transaction_id, user_id, product_id, category, CAST(amount AS DOUBLE) AS amount, transaction_type,
  result, event_time, reason FROM checked WHERE reason IS NOT NULL""",
)
def rejected_facts_query(spark, folder):
    return loading.rejected_facts(tagged_lines(spark, folder)).drop("seq")


@register(
    "insert_ignore_users",
    """SELECT 'user_' || c_custkey AS user_id, c_name AS user_name FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def insert_ignore_users_query(spark, folder):
    """Customers into a users table that has a row for everybody seen in the events."""
    customers = star.users(spark, folder)
    twice = customers.unionByName(customers).withColumn("seq", F.lit(0))
    rows = loading.with_defaults(twice, S.USERS).withColumn("seq", F.lit(0))
    seen = star.events(spark, folder).select("user_id").distinct()
    return loading.insert_ignore(rows, seen, S.USERS, "seq").select("user_id", "user_name")


@register(
    "upsert_stats",
    f"""WITH {EV}, own AS (
  SELECT epoch_ms(t - t % 5000) AS window_start, epoch_ms(t - t % 5000 + 5000) AS window_end, category, {TOTALS}
  FROM ev GROUP BY t - t % 5000, category
), moved AS (
  SELECT window_start, window_end, category, CAST(0 AS DOUBLE) AS total_amount, CAST(0 AS BIGINT) AS transaction_count
  FROM own
  UNION ALL SELECT window_start, window_end, 'none', CAST(0 AS DOUBLE), CAST(0 AS BIGINT) FROM own
  GROUP BY window_start, window_end)
SELECT * FROM own UNION ALL SELECT * FROM moved WHERE category = 'none'""",
)
def upsert_stats_query(spark, folder):
    """The stored log after two batches: zeros for every window and category, and for one more category; then the
    totals, which replace the zeros where they have the same key."""
    path = new_folder(spark, "stats")
    totals = stats.category_totals(star.events(spark, folder))
    nothing = {"total_amount": F.lit(0), "transaction_count": F.lit(0)}
    spare = totals.select("window_start", "window_end", F.lit("none").alias("category")).distinct()
    write = upsert_stats(path, "query")
    write(totals.withColumns(nothing).unionByName(spare.withColumns(nothing)), 0)
    write(totals, 1)
    return read_stats(spark, path)


@register(
    "dimension_refresh",
    f"WITH {USERS} SELECT user_id, user_name, version FROM users, (SELECT unnest([0, 1, 2]) AS version)",
)
def dimension_refresh_query(spark, folder):
    """What a dimension publishes over 300 batches when it is read anew every hundred."""
    path = new_folder(spark, "refresh")
    versions = []

    def publish(users: DataFrame) -> None:
        users.select("user_id", "user_name").write.parquet(f"{path}/version={len(versions)}")
        versions.append(users)

    table = RefreshedTable(lambda: star.users(spark, folder), every=100, on_refresh=publish)
    for batch_id in range(300):
        table.at(batch_id)
    return spark.read.parquet(path)


@register("reload_tables", "SELECT p_type AS category, count(*) || ' products' AS description FROM part GROUP BY p_type")
def reload_tables_query(spark, folder):
    """The categories table created, loaded, emptied and loaded again."""
    database = f"reload_{new_folder(spark, 'x').rpartition('-')[2]}"
    rows = loading.with_defaults(star.categories(spark, folder), S.CATEGORIES)
    done = []
    for _ in range(2):
        done.append(create_or_truncate(spark, database, {"categories": S.CATEGORIES}))
        rows.write.insertInto(f"{database}.categories")
    if done != ["created", "truncated"]:
        raise RuntimeError(f"unexpected steps: {done}")
    return spark.table(f"{database}.categories")


@register(
    "orphan_report",
    f"""WITH {EV}, {KNOWN}
SELECT 'user_id' AS column_name, user_id AS value, count(*) AS "count" FROM ev
WHERE user_id NOT IN (SELECT user_id FROM known) GROUP BY user_id""",
)
def orphan_report_query(spark, folder):
    return quality.orphan_report(event_facts(spark, folder), "user_id", star.supplier_users(spark, folder))


@register(
    "remove_orphans",
    f"""WITH {LINE_FACTS}
SELECT transaction_id, user_id, CASE WHEN s_suppkey IS NOT NULL THEN product_id END AS product_id
FROM facts JOIN customer ON 'user_' || c_custkey = user_id LEFT JOIN supplier ON 'prod_' || s_suppkey = product_id""",
)
def remove_orphans_query(spark, folder):
    """Order lines after the users that are no customers (cascade) and the products with no supplier's number (set null)
    were deleted."""
    to_users, to_products, _ = S.TRANSACTIONS.foreign_keys
    products = star.supplier_users(spark, folder).select(F.regexp_replace("user_id", "user_", "prod_").alias("product_id"))
    kept = quality.remove_orphans(star.line_facts(spark, folder), to_users, star.users(spark, folder))
    return quality.remove_orphans(kept, to_products, products).select("transaction_id", "user_id", "product_id")


@register(
    "duplicate_keys",
    """SELECT 'txn_' || l_orderkey AS transaction_id, count(*) AS "count"
FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
)
def duplicate_keys_query(spark, folder):
    return quality.duplicate_keys(star.line_facts(spark, folder), S.TRANSACTIONS.key)


@register(
    "null_counts",
    """SELECT 'category' AS column_name, count(*) FILTER (WHERE event_type = 'signup' OR event_type = 'click')
  AS null_count FROM events
UNION ALL SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL) FROM events""",
)
def null_counts_query(spark, folder):
    kinds = F.when(~F.col("category").isin("signup", "click"), F.col("category"))
    rows = event_facts(spark, folder).withColumn("category", kinds)
    return quality.null_counts(rows, ("category", "user_id"))


@register(
    "outside_domain",
    """SELECT 'account_type' AS column_name, c_mktsegment AS value, count(*) AS "count"
FROM customer GROUP BY c_mktsegment""",
)
def outside_domain_query(spark, folder):
    """Market segments where an account type is expected."""
    rows = star.users(spark, folder).withColumn("account_type", F.col("device"))
    return quality.outside_domain(rows, "account_type", S.DOMAINS["users"]["account_type"])


# --- streams: the whole events table replayed, in three arrivals ---------------------------------------

# A window is out once the watermark, two seconds behind the newest event, has passed its end.
CLOSED = "(SELECT epoch_ms(max(t) - 2000) FROM ev)"
ARRIVALS = 3
# The third of the time an event is in. With late ones, every tenth event comes with the next arrival.
THIRD = "(3 * (t - first_t)) // (last_t - first_t + 1)"
LATE = f"least(2, {THIRD} + CASE WHEN seq % 10 = 0 THEN 1 ELSE 0 END)"


def arrived_events(spark: SparkSession, folder: str, late: bool = False) -> DataFrame:
    """Events with the ``arrival`` they come with."""
    events = star.events(spark, folder)
    first, last = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    third = F.expr(f"(3 * (timestamp - {first})) div ({last} - {first} + 1)")
    late_by = F.when(F.col("seq") % 10 == 0, 1).otherwise(0) if late else F.lit(0)
    return events.withColumn("arrival", F.least(F.lit(ARRIVALS - 1), third + late_by))


def files_each(rows: DataFrame) -> int:
    """The files of every ``arrival``, by the rows of the one that has fewest: were a file empty, it would not be written,
    and rows of two arrivals came in one trigger."""
    counts = {r.arrival: r["count"] for r in rows.groupBy("arrival").count().collect()}
    return arrival_files(ARRIVALS * min(counts.get(n, 0) for n in range(ARRIVALS)), ARRIVALS)


def replays(
    spark: SparkSession, folder: str, names: tuple[str, ...], settings: RiskSettings, late: bool = False
) -> list[DataFrame]:
    """Run streaming results side by side over all events there are, put down once, a trigger per arrival, and read what
    each wrote."""
    out = new_folder(spark, f"replay-{names[0]}")
    # State keeps its number of partitions for good, so it is set for the cluster and not left to a default.
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        rows = arrived_events(spark, folder, late)
        files = files_each(rows)
        write_arrivals(rows, "arrival", f"{out}/in", range(ARRIVALS), files)
        started = []
        for name in names:
            events = watermarked(replay_arrivals(spark, f"{out}/in", S.EVENT_SCHEMA, files), settings)
            result, to = RESULTS[name], f"{out}/{name}"
            write = write_batches(f"{to}/rows", "replay")
            checkpoint = f"{to}/checkpoint"
            started.append(
                start(result.build(events, settings), write, checkpoint, result.output_mode, {"availableNow": True})
            )
        for query in started:
            query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return [spark.read.parquet(f"{out}/{name}/rows").drop("run") for name in names]


def replayed(spark: SparkSession, folder: str, name: str, settings: RiskSettings, late: bool = False) -> DataFrame:
    return replays(spark, folder, (name,), settings, late)[0].drop("batch_id")


@register("stream_large_amount", f"WITH {EV} {LARGE_SQL.format(source='ev', limit='200.0')}")
def stream_large_amount_query(spark, folder):
    return replayed(spark, folder, "large_amount", SAMPLE)


@register("stream_high_frequency", f"WITH {EV}, {DAY_BURSTS} {DAY_BURST_SQL}")
def stream_high_frequency_query(spark, folder):
    return replayed(spark, folder, "high_frequency", SAMPLE)


@register("stream_continuous_increase", f"WITH {EV}, {RUNS} {GROWTH_SQL}")
def stream_continuous_increase_query(spark, folder):
    return replayed(spark, folder, "continuous_increase", SAMPLE)


@register(
    "stream_failed_surge",
    f"WITH {EV}, alerts AS ({SURGE_SQL}) SELECT * FROM alerts WHERE window_end <= {CLOSED}",
)
def stream_failed_surge_query(spark, folder):
    return replayed(spark, folder, "failed_surge", SAMPLE)


@register(
    "stream_ip_sharing",
    f"WITH {EV}, {SHARED}, alerts AS ({SHARED_SQL}) SELECT * FROM alerts WHERE window_end <= {CLOSED}",
)
def stream_ip_sharing_query(spark, folder):
    return replayed(spark, folder, "ip_sharing", SAMPLE)


@register(
    "stream_ip_sharing_members",
    f"""WITH {EV}, {SHARED}
SELECT DISTINCT epoch_ms(w) AS window_start, epoch_ms(w + 3600000) AS window_end, ev.ip_address, ev.user_id
FROM ev JOIN shared ON shared.w = t - t % 3600000 AND shared.ip_address = ev.ip_address
WHERE epoch_ms(w + 3600000) <= {CLOSED}""",
)
def stream_ip_sharing_members_query(spark, folder):
    """The users behind the alerts, from what two streams have stored."""
    users, alerts = replays(spark, folder, ("ip_sharing_users", "ip_sharing"), SAMPLE)
    users = users.selectExpr("window.start AS window_start", "window.end AS window_end", "ip_address", "user_id")
    return users.join(alerts, ["window_start", "window_end", "ip_address"], "left_semi")


@register("stream_running_totals", f"WITH {EV} SELECT {TOTALS} FROM ev")
def stream_running_totals_query(spark, folder):
    """The total that the last trigger gave."""
    totals = replays(spark, folder, ("running_totals",), SAMPLE)[0]
    return totals.agg(*[F.max_by(c, "batch_id").alias(c) for c in ("total_amount", "transaction_count")])


@register(
    "stream_window_totals",
    f"""WITH {EV}, {STATS} SELECT window_start, window_end, total_amount, transaction_count FROM stats
WHERE is_total AND window_end <= {CLOSED}""",
)
def stream_window_totals_query(spark, folder):
    return replayed(spark, folder, "window_totals", SAMPLE)


@register(
    "stream_category_totals",
    f"""WITH {EV}, {STATS} SELECT window_start, window_end, category, total_amount, transaction_count FROM stats
WHERE NOT is_total AND window_end <= {CLOSED}""",
)
def stream_category_totals_query(spark, folder):
    return replayed(spark, folder, "category_totals", SAMPLE)


@register(
    "stream_product_totals",
    f"""WITH {EV}
SELECT epoch_ms(t - t % 3600000) AS window_start, epoch_ms(t - t % 3600000 + 3600000) AS window_end,
  product_name, first(category ORDER BY t, seq) AS category, {TOTALS}
FROM ev GROUP BY t - t % 3600000, product_name HAVING window_end <= {CLOSED}""",
)
def stream_product_totals_query(spark, folder):
    return replayed(spark, folder, "product_totals", RiskSettings(stats_window_seconds=HOUR))


@register(
    "stream_late_rows",
    f"""WITH {EV}, arriving AS (
  SELECT ev.*, {LATE} AS arrival FROM ev, (SELECT min(t) AS first_t, max(t) AS last_t FROM ev)
), marks AS (
  SELECT n AS arrival, (SELECT max(t) - 2000 FROM arriving WHERE arrival < n - 1) AS mark FROM range(0, 3) AS numbers(n)
)
SELECT epoch_ms(t - t % 3600000) AS window_start, epoch_ms(t - t % 3600000 + 3600000) AS window_end, {TOTALS}
FROM arriving JOIN marks USING (arrival) WHERE mark IS NULL OR t - t % 3600000 + 3600000 > mark
GROUP BY t - t % 3600000 HAVING window_end <= {CLOSED}""",
)
def stream_late_rows_query(spark, folder):
    """Window totals where every tenth event comes with the next arrival. A trigger leaves out what the watermark of the
    one before it had closed, so those of the second arrival count and those of the third don't."""
    return replayed(spark, folder, "window_totals", RiskSettings(stats_window_seconds=HOUR), late=True)


@register(
    "stream_risk_alerts",
    f"""WITH {ALERTS} SELECT * FROM alert_rows
WHERE alert_type NOT IN ('FAILED_SURGE', 'IP_SHARING') OR window_end <= {CLOSED}""",
)
def stream_risk_alerts_query(spark, folder):
    """The alerts of all detectors as streams over one feed append them to one table, put together between the runs."""
    out = new_folder(spark, "alerts")
    names = ("large_amount", "high_frequency", "continuous_increase", "failed_surge", "ip_sharing")
    rows = arrived_events(spark, folder)
    files = files_each(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        for numbers in (range(ARRIVALS - 1), range(ARRIVALS - 1, ARRIVALS)):
            write_arrivals(rows, "arrival", f"{out}/in", numbers, files)
            events = replay_arrivals(spark, f"{out}/in", S.EVENT_SCHEMA, files)
            for query in start_results(events, out, names=names, settings=SAMPLE, trigger={"availableNow": True}).values():
                query.awaitTermination()
            compact_alerts(spark, f"{out}/alerts", clear=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return read_alerts(spark, f"{out}/alerts")


@register(
    "stream_stats_history",
    f"""WITH {EV}, {STATS} SELECT window_start, window_end, category, total_amount, transaction_count FROM stats
WHERE window_end <= {CLOSED} ORDER BY window_start DESC, window_end, category, total_amount, transaction_count LIMIT 200""",
)
def stream_stats_history_query(spark, folder):
    """The newest windows of the statistics that two streams have stored, read from the newest days."""
    path = new_folder(spark, "stats")
    names = ("window_totals", "category_totals")
    for name, rows in zip(names, replays(spark, folder, names, SAMPLE), strict=True):
        upsert_stats(path, name)(rows, 0)
    return reports.stats_history(read_newest_stats(spark, path, 200))


@register(
    "stream_load_facts",
    f"""WITH {LINE_FACTS}, sound AS (
  SELECT facts.*, row_number() OVER (PARTITION BY transaction_id
    ORDER BY l_linenumber % 3, l_linenumber, l_partkey, l_suppkey, amount, event_time) AS place
  FROM facts JOIN customer ON 'user_' || c_custkey = user_id
)
SELECT transaction_id, user_id, product_id, category, CAST(amount AS DOUBLE) AS amount, transaction_type,
  result, event_time FROM sound WHERE place = 1""",
)
def stream_load_facts_query(spark, folder):
    """Order lines loaded in three arrivals, over which most orders repeat."""
    out = new_folder(spark, "facts")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        lines = star.line_facts(spark, folder).withColumn("arrival", F.col("seq.l_linenumber") % ARRIVALS)
        numbers = spark.read.parquet(f"{folder}/lineitem.parquet").select(F.col("l_linenumber") % ARRIVALS)
        files = files_each(numbers.toDF("arrival"))
        write_arrivals(lines, "arrival", f"{out}/in", range(ARRIVALS), files)
        schema = spark.read.parquet(f"{out}/in/arrival-0").schema
        start_fact_load(
            replay_arrivals(spark, f"{out}/in", schema, files),
            out,
            RefreshedTable(lambda: star.users(spark, folder)),
            RefreshedTable(lambda: star.products(spark, folder)),
            RefreshedTable(lambda: star.categories(spark, folder)),
            period="year",
            trigger={"availableNow": True},
            id_files=files,
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return read_facts(spark, out).drop("period", "process_time")


@register(
    "stream_enriched",
    f"""WITH {EV}, {KNOWN}, arriving AS (
  SELECT ev.*, {THIRD} AS arrival FROM ev, (SELECT min(t) AS first_t, max(t) AS last_t FROM ev)
)
SELECT '{{"transaction_id":"' || transaction_id || '","user_id":"' || arriving.user_id || '","product_id":"' || product_id
  || '","category":"' || category || '","amount":' || CAST(amount AS VARCHAR) || ',"transaction_type":"purchase"'
  || ',"result":"' || result || '","ip_address":"' || CASE WHEN arrival < 1 THEN '0.0.0.0'
  ELSE coalesce(known.ip_address, '0.0.0.0') END || '","product_name":"' || coalesce(p_name, 'unknown')
  || '","timestamp":' || t || '}}' AS value
FROM arriving LEFT JOIN known ON known.user_id = arriving.user_id LEFT JOIN part ON 'prod_' || p_partkey = product_id""",
)
def stream_enriched_query(spark, folder):
    """Event messages of a stream whose users come to be known between the first trigger and the second."""
    out = new_folder(spark, "enriched")
    columns = [f for f in S.TRANSACTIONS.schema.fieldNames() if f != "process_time"]
    write_arrivals(arrived_events(spark, folder).select(*columns, "arrival"), "arrival", f"{out}/in", range(ARRIVALS))
    facts = replay_arrivals(spark, f"{out}/in", spark.read.parquet(f"{out}/in/arrival-0").schema)
    suppliers = star.supplier_users(spark, folder)
    suppliers.limit(0).write.parquet(f"{out}/users")
    users = RefreshedTable(lambda: spark.read.schema(suppliers.schema).parquet(f"{out}/users"), every=1)
    products = RefreshedTable(lambda: star.products(spark, folder))
    write = to_text(f"{out}/messages", lambda messages: messages)

    def enrich_and_learn(batch: DataFrame, batch_id: int) -> None:
        enriching(users, products, write)(batch, batch_id)
        if not batch_id:
            suppliers.write.mode("overwrite").parquet(f"{out}/users")

    start(facts, enrich_and_learn, f"{out}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return spark.read.text(f"{out}/messages").select("value")
