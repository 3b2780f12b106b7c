"""Loading dimension and fact rows with the declared keys and references enforced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import TRANSACTIONS, TableSpec


def with_defaults(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows in the table's columns and types. Columns that are not there are filled by the declared default
    or null; a null that is there stays."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(spec.defaults.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in spec.schema.fields
        ]
    )


def insert_ignore(rows: DataFrame, existing: DataFrame, spec: TableSpec, order: str) -> DataFrame:
    """The rows whose key is new; of several with one key the first in ``order``.

    The first is found by a partial aggregate, so a key with very many copies is one row per task.
    """
    key = list(spec.key)
    columns = spec.schema.fieldNames()
    first = F.min_by(F.struct(*columns), F.struct(order, *columns))
    return (
        rows.groupBy(*[F.col(k).alias(f"key_{k}") for k in key])
        .agg(first.alias("row"))
        .select("row.*")
        .join(existing.select(*key), key, "left_anti")
    )


def check_references(
    facts: DataFrame,
    users: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    ways: tuple[str | None, str | None, str | None] = (None, None, None),
) -> DataFrame:
    """Facts with a ``reason`` where a required column is null or a reference leads nowhere.

    The distinct keys of each dimension are joined; how is left to their measured size, or said by a hint in ``ways`` for
    each where nothing is measured, as in streams.
    """
    dimensions = {"users": users, "products": products, "categories": categories}
    hints = dict(zip(dimensions, ways, strict=True))
    reasons = [F.when(F.col(n).isNull(), F.lit(f"{n} is null")) for n in TRANSACTIONS.required]
    checked = facts.withColumn("reason", F.coalesce(*reasons))
    for reference in TRANSACTIONS.foreign_keys:
        keys = dimensions[reference.table].select(reference.column).distinct()
        keys = keys.withColumn("known", F.lit(True))
        way = hints[reference.table]
        checked = checked.join(keys.hint(way) if way else keys, reference.column, "left")
        lost = F.col(reference.column).isNotNull() & F.col("known").isNull()
        missing = F.when(lost, F.lit(f"no such {reference.column}"))
        checked = checked.withColumn("reason", F.coalesce("reason", missing)).drop("known")
    return checked.select(*facts.columns, "reason")


def tagged_facts(checked: DataFrame, existing: DataFrame, order: str = "seq") -> DataFrame:
    """Checked facts with every row's final ``reason``, null for those to insert.

    As if inserted one by one in ``order``, skipping what breaks a constraint: of each transaction id that is not
    stored yet, the first sound row goes in. ``order`` is unique among the rows of one id. The first is found by a
    partial aggregate and joined back, so an id with very many copies is one row per task on one side, and adaptive
    execution can split the other.
    """
    columns = checked.columns
    stored = existing.select("transaction_id").distinct().withColumn("stored", F.lit(True))
    first = (
        checked.where("reason IS NULL")
        .groupBy("transaction_id")
        .agg(F.min(order).alias("first"))
        .join(stored, "transaction_id", "left")
    )
    lost = F.col("stored") | (F.col(order) != F.col("first"))
    return (
        checked.join(first, "transaction_id", "left")
        .withColumn("reason", F.coalesce("reason", F.when(lost, F.lit("duplicate transaction_id"))))
        .select(*columns)
    )


def accepted_facts(tagged: DataFrame) -> DataFrame:
    """The rows to insert, in the columns of ``transactions``."""
    return with_defaults(tagged.where("reason IS NULL"), TRANSACTIONS)


def rejected_facts(tagged: DataFrame) -> DataFrame:
    """The rows left out, each with its ``reason``."""
    return tagged.where("reason IS NOT NULL")
