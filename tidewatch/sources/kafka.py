"""Kafka topics. The connector package (spark-sql-kafka) has to be on the cluster's classpath."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.parse import parse
from tidewatch.schemas import EVENTS_TOPIC, RESULT_TOPICS


def kafka_options(
    servers: str,
    topics: tuple[str, ...],
    starting: str = "latest",
    group_id: str | None = None,
    per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_topics(
    spark: SparkSession, servers: str, topics: tuple[str, ...] = RESULT_TOPICS, **options
) -> DataFrame:
    """Stream of (topic, value) with the value as text, ready for ``tagged_messages``."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options)).load()
    return stream.select("topic", F.col("value").cast("string").alias("value"))


def arrival(timestamp: Column, offset: Column) -> Column:
    """Arrival order as one number: the broker's clock, and within its millisecond the offset. It compares across
    partitions, where offsets alone do not, and keeps the order of each partition but for a million-th of the
    milliseconds, in which the offset's last 20 bits begin anew."""
    return F.unix_millis(timestamp) * F.lit(1 << 20) + F.pmod(offset, F.lit(1 << 20))


def read_events(spark: SparkSession, servers: str, topic: str = EVENTS_TOPIC, **options) -> DataFrame:
    """Parsed stream of transaction events (see ``parse``), in the order of ``arrival``."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, (topic,), **options)).load()
    text = stream.select(F.col("value").cast("string").alias("value"), "timestamp", "offset")
    return parse(text, seq=arrival(F.col("timestamp"), F.col("offset")))
