"""Names, schemas and keys of the events, tables and topics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The fields of a transaction event, required ones and defaults of absent ones.
REQUIRED_FIELDS = ("user_id", "amount", "timestamp", "transaction_id")
FIELD_DEFAULTS = {
    "category": "unknown",
    "result": "success",
    "transaction_type": "purchase",
    "ip_address": "0.0.0.0",
    "product_id": "unknown",
    "product_name": "unknown",
}

# Topics.
EVENTS_TOPIC = "transaction_events"
USERS_TOPIC = "user_info"
ALERTS_TOPIC = "alarm_events"
RUNNING_TOTALS_TOPIC = "total_amount_and_count_events"
WINDOW_TOTALS_TOPIC = "window_count_and_amount_events"
CATEGORY_TOTALS_TOPIC = "category_aggregated_events"
PRODUCT_TOTALS_TOPIC = "product_aggregated_events"
RESULT_TOPICS = (
    ALERTS_TOPIC,
    RUNNING_TOTALS_TOPIC,
    WINDOW_TOTALS_TOPIC,
    CATEGORY_TOTALS_TOPIC,
    PRODUCT_TOTALS_TOPIC,
)

# Alert types and the labels that stand for "everybody" and "all categories".
LARGE_AMOUNT = "LARGE_AMOUNT"
HIGH_FREQUENCY = "HIGH_FREQUENCY"
CONTINUOUS_INCREASE = "CONTINUOUS_INCREASE"
FAILED_SURGE = "FAILED_SURGE"
IP_SHARING = "IP_SHARING"
EVERYBODY = "GLOBAL"
ALL_CATEGORIES = "ALL"

# Allowed values of the coded columns.
DOMAINS = {
    "users": {"account_type": ("normal", "vip")},
    "products": {"status": ("active", "inactive")},
    "transactions": {
        "transaction_type": ("purchase", "refund", "transfer"),
        "result": ("success", "failed", "processing"),
    },
}

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)
# Time order, made total: seq is the arrival order (an offset or a source id), the id settles the rest.
EVENT_ORDER = ("timestamp", "seq", "transaction_id")

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("sequence_length", T.IntegerType()),
        T.StructField("amounts", T.ArrayType(T.DoubleType())),
        T.StructField("ip_address", T.StringType()),
        T.StructField("user_count", T.LongType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("alert_time", T.TimestampType()),
        T.StructField("details", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    on_delete: str  # "cascade", "set_null" or "restrict"


@dataclass(frozen=True)
class TableSpec:
    """Columns and declared constraints of one table; Spark tables do not enforce them themselves."""

    schema: T.StructType
    key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)


_STRING, _TIME, _COUNT = T.StringType(), T.TimestampType(), T.LongType()


def _must(name: str, data_type: T.DataType) -> T.StructField:
    return T.StructField(name, data_type, nullable=False)


def _may(name: str, data_type: T.DataType) -> T.StructField:
    return T.StructField(name, data_type)


CATEGORIES = TableSpec(
    T.StructType([_must("category", _STRING), _may("description", _STRING)]), key=("category",)
)
USERS = TableSpec(
    T.StructType(
        [
            _must("user_id", _STRING),
            _must("user_name", _STRING),
            _may("ip_address", _STRING),
            _may("account_type", _STRING),
            _may("device", _STRING),
            _may("created_at", _TIME),
            _may("updated_at", _TIME),
        ]
    ),
    key=("user_id",),
    defaults={"account_type": "normal"},
)
PRODUCTS = TableSpec(
    T.StructType(
        [
            _must("product_id", _STRING),
            _must("category", _STRING),
            _may("product_name", _STRING),
            _must("price", T.DecimalType(10, 2)),
            _may("status", _STRING),
            _may("created_at", _TIME),
            _may("updated_at", _TIME),
        ]
    ),
    key=("product_id",),
    foreign_keys=(ForeignKey("category", "categories", "restrict"),),
    defaults={"status": "active"},
)
TRANSACTIONS = TableSpec(
    T.StructType(
        [
            _must("transaction_id", _STRING),
            _must("user_id", _STRING),
            _may("product_id", _STRING),
            _must("category", _STRING),
            _must("amount", T.DecimalType(28, 2)),
            _may("transaction_type", _STRING),
            _may("result", _STRING),
            _must("event_time", _TIME),
            _may("process_time", _TIME),
        ]
    ),
    key=("transaction_id",),
    foreign_keys=(
        ForeignKey("user_id", "users", "cascade"),
        ForeignKey("product_id", "products", "set_null"),
        ForeignKey("category", "categories", "restrict"),
    ),
    defaults={"transaction_type": "purchase", "result": "success"},
)
TRANSACTION_STATS = TableSpec(
    T.StructType(
        [
            _must("window_start", _TIME),
            _must("window_end", _TIME),
            _must("category", _STRING),
            _must("total_amount", T.DecimalType(38, 2)),
            _must("transaction_count", _COUNT),
        ]
    ),
    key=("window_start", "window_end", "category"),
)
RISK_ALERTS = TableSpec(
    T.StructType(
        [
            _must("alert_type", _STRING),
            _must("user_id", _STRING),
            _may("transaction_id", _STRING),
            _may("amount", T.DecimalType(28, 2)),
            _may("transaction_count", _COUNT),
            _may("window_start", _TIME),
            _may("window_end", _TIME),
            _may("details", _STRING),
            _must("alert_time", _TIME),
        ]
    )
)
TABLES = {
    "categories": CATEGORIES,
    "users": USERS,
    "products": PRODUCTS,
    "transactions": TRANSACTIONS,
    "transaction_stats": TRANSACTION_STATS,
    "risk_alerts": RISK_ALERTS,
}
