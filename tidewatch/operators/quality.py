"""Checks of the declared constraints, as reports and as clean-up. All count by partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import ForeignKey, TableSpec


def duplicate_keys(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("count")).where("count > 1")


def null_counts(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per column with its number of nulls."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def orphan_report(rows: DataFrame, column: str, parents: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Values of a reference that have no parent row, with how many rows use them. Rows are counted per value
    before the look-up, so the join never sees a value twice."""
    keys = parents.select(F.col(parent_column or column).alias("value"))
    used = (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("count"))
    )
    return used.join(keys, "value", "left_anti").select(
        F.lit(column).alias("column_name"), "value", "count"
    )


def remove_orphans(rows: DataFrame, reference: ForeignKey, parents: DataFrame) -> DataFrame:
    """What the declared delete rule leaves when parents are gone: ``cascade`` drops the rows, ``set_null``
    empties the column, ``restrict`` stops the job at the first orphan."""
    column = reference.column
    keys = parents.select(column).distinct()
    known = rows.join(keys.withColumn("known", F.lit(True)), column, "left")
    if reference.on_delete == "cascade":
        return known.where(F.col("known") | F.col(column).isNull()).select(*rows.columns)
    if reference.on_delete == "set_null":
        value = F.when(F.col("known"), F.col(column))
    elif reference.on_delete == "restrict":
        orphan = F.col(column).isNotNull() & F.col("known").isNull()
        message = F.concat(F.lit(f"no {reference.table} row for {column} "), F.col(column))
        value = F.when(orphan, F.raise_error(message).cast("string")).otherwise(F.col(column))
    else:
        raise ValueError(f"unknown delete rule {reference.on_delete!r}")
    return known.withColumn(column, value).select(*rows.columns)


def outside_domain(rows: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Values of a coded column that are not among the allowed ones, with their number of rows."""
    return (
        rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
        .groupBy(F.lit(column).alias("column_name"), F.col(column).alias("value"))
        .agg(F.count("*").alias("count"))
    )


def check_table(
    rows: DataFrame, spec: TableSpec, domains: dict[str, tuple[str, ...]] | None = None
) -> dict[str, DataFrame]:
    """The reports that need no other table, by name."""
    reports = {"null_counts": null_counts(rows, spec.required)}
    if spec.key:
        reports["duplicate_keys"] = duplicate_keys(rows, spec.key)
    for column, allowed in (domains or {}).items():
        reports[f"domain_{column}"] = outside_domain(rows, column, allowed)
    return reports
