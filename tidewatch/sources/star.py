"""Transactions, users and products from a star schema of events, customers, parts and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.schemas import EVENT_SCHEMA

# The pool of 30 client addresses.
_ADDRESS_POOL = 30


def _address(number):
    """10.0.{n div 10}.{n mod 10 + 1}"""
    tens = F.floor(number / 10).cast("string")
    return F.concat(F.lit("10.0."), tens, F.lit("."), (F.pmod(number, F.lit(10)) + 1).cast("string"))


def _key(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def adapt_events(events: DataFrame) -> DataFrame:
    """Rows of ``events``, batch or stream, as transaction events. Needs a UTC session."""
    k = F.regexp_extract("props", '"k": *([0-9]+)', 1).cast("int")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    failed = F.col("event_type") == "error"
    columns = {
        "user_id": _key("user_", "user_id"),
        "amount": F.col("value"),
        "category": F.col("event_type"),
        "timestamp": F.col("millis"),
        "transaction_id": _key("txn_", "event_id"),
        "result": F.when(failed, "failed").otherwise("success"),
        "transaction_type": F.lit("purchase"),
        "ip_address": _address(F.col("k")),
        "product_id": _key("prod_", "k"),
        "product_name": F.concat(F.lit("Product "), F.col("k").cast("string")),
        "event_time": F.timestamp_millis("millis"),
        "seq": F.col("event_id"),
    }
    return events.withColumns({"k": k, "millis": millis}).select(
        *[columns[f.name].alias(f.name) for f in EVENT_SCHEMA.fields]
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return adapt_events(spark.read.parquet(f"{folder}/events.parquet"))


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of ``orders`` as transaction events: far larger amounts, days apart."""
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    columns = {
        "user_id": _key("user_", "o_custkey"),
        "amount": F.col("o_totalprice"),
        "category": F.col("o_orderpriority"),
        "timestamp": F.col("millis"),
        "transaction_id": _key("txn_", "o_orderkey"),
        "result": F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success"),
        "transaction_type": F.lit("purchase"),
        "ip_address": F.lit("0.0.0.0"),
        "product_id": F.lit("unknown"),
        "product_name": F.lit("unknown"),
        "event_time": F.timestamp_millis("millis"),
        "seq": F.col("o_orderkey"),
    }
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("millis", millis)
    return orders.select(*[columns[f.name].alias(f.name) for f in EVENT_SCHEMA.fields])


def users(spark: SparkSession, folder: str) -> DataFrame:
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    return customers.select(
        _key("user_", "c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        _address(F.pmod("c_custkey", F.lit(_ADDRESS_POOL))).alias("ip_address"),
        F.when(F.col("c_acctbal") >= 5000, "vip").otherwise("normal").alias("account_type"),
        F.col("c_mktsegment").alias("device"),
    )


def supplier_users(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as users. The events have users that are no supplier's."""
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    return suppliers.select(
        _key("user_", "s_suppkey").alias("user_id"),
        F.col("s_name").alias("user_name"),
        _address(F.pmod("s_suppkey", F.lit(_ADDRESS_POOL))).alias("ip_address"),
        F.lit("normal").alias("account_type"),
        F.lit(None).cast("string").alias("device"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    parts = spark.read.parquet(f"{folder}/part.parquet")
    return parts.select(
        _key("prod_", "p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.lit("active").alias("status"),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    """Product types, described by their number of products."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    return parts.groupBy(F.col("p_type").alias("category")).agg(
        F.concat(F.count("*").cast("string"), F.lit(" products")).alias("description")
    )


def line_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as facts to load. The transaction id is the order, so orders with several lines repeat it; the user
    has the number of the part, and there are more parts than customers; the category is the product's type. ``seq``
    orders the lines of an order."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    types = products(spark, folder).select("product_id", "category")
    priced = F.col("l_extendedprice").cast("decimal(12,2)")
    seq = F.struct("l_linenumber", "l_partkey", "l_suppkey", priced.alias("price"), "l_shipdate")
    return lines.select(
        _key("txn_", "l_orderkey").alias("transaction_id"),
        _key("user_", "l_partkey").alias("user_id"),
        _key("prod_", "l_partkey").alias("product_id"),
        priced.alias("amount"),
        F.when(F.col("l_returnflag") == "R", "refund").otherwise("purchase").alias("transaction_type"),
        F.when(F.col("l_linestatus") == "O", "processing").otherwise("success").alias("result"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        seq.alias("seq"),
    ).join(types, "product_id", "left")
