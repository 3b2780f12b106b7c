"""Session settings and durable intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# What every job here expects. Sizes (shuffle partitions, memory) belong to the cluster, not to this list.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash instead of sort for joins whose smaller side is measured to have no partition above this.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A batch uploads its changes of the state, not whole snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of the state costs one more lookup for every row written or removed.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: as the cluster names it in ``spark.checkpoint.dir``, and where it names
    none, next to the tables in the warehouse, which they reach as well."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.work"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there: its rows are fixed, a lost executor
    costs no recomputation, and later readers take only the columns they need. The folder stays until the
    cluster clears it."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
