"""Streaming queries: one per result, each with its own checkpoint, over the same parsed events.

One query per result keeps a slow or failing one from holding up the others. So that ten queries don't read and parse
the topic ten times, a feed does it once and lays the events down in columns; each result reads the few it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewatch import schemas as S
from tidewatch.operators import detectors, enrich, stats
from tidewatch.settings import DEFAULTS, RiskSettings
from tidewatch.sinks.messages import each_of, to_text, to_topic
from tidewatch.sinks.tables import BatchWriter, append_alerts, make_folder, upsert_stats, write_batches
from tidewatch.sources.tables import RefreshedTable
from tidewatch.streaming.stateful import stream_continuous_increase, stream_high_frequency


@dataclass(frozen=True)
class Result:
    build: Callable[[DataFrame, RiskSettings], DataFrame]
    messages: Callable[[DataFrame], DataFrame] | None
    topic: str | None
    table: str | None  # "alerts", "stats" or "users" if the result is stored as well
    output_mode: str = "append"


RESULTS = {
    "large_amount": Result(detectors.large_amount, enrich.alert_messages, S.ALERTS_TOPIC, "alerts"),
    "high_frequency": Result(stream_high_frequency, enrich.alert_messages, S.ALERTS_TOPIC, "alerts"),
    "continuous_increase": Result(
        stream_continuous_increase, enrich.alert_messages, S.ALERTS_TOPIC, "alerts"
    ),
    "failed_surge": Result(detectors.failed_surge, enrich.alert_messages, S.ALERTS_TOPIC, "alerts"),
    "ip_sharing": Result(detectors.ip_sharing, enrich.alert_messages, S.ALERTS_TOPIC, "alerts"),
    "ip_sharing_users": Result(detectors.ip_sharing_users, None, None, "users"),
    "running_totals": Result(
        lambda events, settings: stats.overall_totals(events),
        enrich.running_messages,
        S.RUNNING_TOTALS_TOPIC,
        None,
        "complete",
    ),
    "window_totals": Result(stats.window_totals, enrich.stats_messages, S.WINDOW_TOTALS_TOPIC, "stats"),
    "category_totals": Result(
        stats.category_totals, enrich.stats_messages, S.CATEGORY_TOTALS_TOPIC, "stats"
    ),
    "product_totals": Result(
        stats.product_totals, enrich.stats_messages, S.PRODUCT_TOTALS_TOPIC, None
    ),
}


def watermarked(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Windows close, and later rows are dropped, this much behind the newest event."""
    return events.withWatermark("event_time", f"{settings.lateness_seconds} seconds")


def start(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    output_mode: str = "append",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    writer = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .foreachBatch(write)
    )
    return writer.queryName(name).start() if name else writer.start()


def start_feed(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Lay the events of a stream down in ``path``, each exactly once, for any number of ``read_feed``."""
    writer = events.writeStream.format("parquet").option("checkpointLocation", checkpoint).queryName("feed")
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start(path)


def read_feed(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The events of a feed as a stream. A query over it reads only the columns it uses."""
    reader = spark.readStream.schema(S.EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def start_results(
    events: DataFrame,
    root: str,
    servers: str | None = None,
    names: tuple[str, ...] = tuple(RESULTS),
    settings: RiskSettings = DEFAULTS,
    trigger: dict | None = None,
    run: str = "main",
    shared: bool = True,
    files_per_trigger: int | None = None,
) -> dict[str, StreamingQuery]:
    """Start the named results of a stream of good events.

    Below ``root``, a folder all executors can reach, are the checkpoints, the events of the feed and the tables
    ``alerts`` and ``stats``. Messages go to the topics of ``servers``, or without it to text files below
    ``root/topics``. With ``shared`` one more query, ``feed``, reads the stream for all; with a trigger that ends with its
    input it has ended before the others start. Bound the triggers of the stream, and with ``files_per_trigger`` those of
    the results.
    """
    ends = (trigger or {}).get("availableNow") or (trigger or {}).get("once")
    if ends:
        settings = replace(settings, burst_idle_ms=0)
    started = {}
    if shared:
        spark, path = events.sparkSession, f"{root}/events"
        make_folder(spark, path)  # there to listen to
        started["feed"] = start_feed(events, path, f"{root}/checkpoints/feed-{run}", trigger)
        if ends:
            started["feed"].awaitTermination()
        events = read_feed(spark, path, files_per_trigger)
    events = watermarked(events, settings)
    for name in names:
        result = RESULTS[name]
        writers = []
        if result.topic and servers:
            writers.append(to_topic(servers, result.topic, result.messages))
        elif result.topic:
            writers.append(to_text(f"{root}/topics/{result.topic}/{name}-{run}", result.messages))
        if result.table == "alerts":
            writers.append(append_alerts(f"{root}/alerts", name, run))
        elif result.table == "stats":
            writers.append(upsert_stats(f"{root}/stats", f"{name}-{run}"))
        elif result.table == "users":
            writers.append(write_batches(f"{root}/users", f"{name}-{run}"))
        started[name] = start(
            result.build(events, settings),
            each_of(*writers),
            f"{root}/checkpoints/{name}-{run}",
            result.output_mode,
            trigger,
            name,
        )
    return started


def enriching(
    users: RefreshedTable, products: RefreshedTable, write: BatchWriter
) -> BatchWriter:
    """For ``foreachBatch`` over a stream of facts: enrich with the present dimensions and hand the event
    messages on."""

    def enrich_batch(batch: DataFrame, batch_id: int) -> None:
        enriched = enrich.enrich_transactions(batch, users.at(batch_id), products.at(batch_id))
        write(enrich.event_messages(enriched), batch_id)

    return enrich_batch
