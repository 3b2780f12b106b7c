"""Dimension and result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, name: str, columns: tuple[str, ...] = (), format: str = "table", **options
) -> DataFrame:
    """A catalog table, a path of files (``format="parquet"`` and the like) or a JDBC table.

    For a large JDBC table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``,
    or one task reads it all. The chosen columns are the only ones read.
    """
    if format == "table":
        table = spark.read.options(**options).table(name)
    elif format == "jdbc":
        table = spark.read.format("jdbc").options(dbtable=name, **options).load()
    else:
        table = spark.read.format(format).options(**options).load(name)
    return table.select(*columns) if columns else table


class RefreshedTable:
    """A dimension for use in ``foreachBatch`` that is read anew every ``every`` batches.

    ``on_refresh`` gets the fresh table, for instance to publish a snapshot of it.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        every: int = 100,
        on_refresh: Callable[[DataFrame], None] | None = None,
    ):
        self._load = load
        self._every = every
        self._on_refresh = on_refresh
        self._age: int | None = None
        self._table: DataFrame | None = None

    def at(self, batch_id: int) -> DataFrame:
        age = batch_id // self._every
        if self._table is None or age != self._age:
            self._table, self._age = self._load(), age
            if self._on_refresh:
                self._on_refresh(self._table)
        return self._table
