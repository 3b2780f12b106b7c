"""Messages (value, and a key where there is one) to topics or to text files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.sinks.tables import BatchWriter


def to_topic(servers: str, topic: str, messages) -> BatchWriter:
    """For ``foreachBatch``: ``messages(batch)`` to a Kafka topic, at least once. Needs the connector on the
    cluster's classpath."""

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(messages(batch), servers, topic)

    return write


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """A whole DataFrame of messages to a topic, such as a snapshot of the users."""
    writer = messages.write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def to_text(path: str, messages) -> BatchWriter:
    """The same to text files, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        messages(batch).select("value").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def each_of(*writers: BatchWriter) -> BatchWriter:
    """Several sinks for one query. The batch's result, which is small, is kept for the time of writing, so
    its state is not computed once per sink."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write
