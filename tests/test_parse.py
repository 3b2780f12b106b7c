import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.enrich import event_messages
from tidewatch.operators.parse import good_events, parse, parse_events, rejected_events

GOOD = {"user_id": "u", "amount": 12.5, "timestamp": 1700000000123, "transaction_id": "t"}


def parsed(spark, *values):
    texts = [(v if isinstance(v, str) or v is None else json.dumps(v),) for v in values]
    return parse(spark.createDataFrame(texts, "value string"))


def test_defaults_are_for_absent_fields_only(spark):
    row = good_events(parsed(spark, {**GOOD, "category": None})).first()
    assert row.category is None
    assert (row.result, row.transaction_type, row.ip_address) == ("success", "purchase", "0.0.0.0")
    assert (row.product_id, row.product_name) == ("unknown", "unknown")
    assert row.event_time.timestamp() == pytest.approx(1700000000.123)


def test_numbers(spark):
    rows = good_events(
        parsed(
            spark,
            {**GOOD, "amount": "12.5", "timestamp": "1700000000123"},
            {**GOOD, "amount": 3, "timestamp": 1700000000123.9},
        )
    ).collect()
    assert [(r.amount, r.timestamp) for r in rows] == [(12.5, 1700000000123), (3.0, 1700000000123)]


@pytest.mark.parametrize(
    "value, error",
    [
        ("nonsense", "not a JSON object"),
        ("[1]", "not a JSON object"),
        ("", "not a JSON object"),
        (None, "not a JSON object"),
        ({k: v for k, v in GOOD.items() if k != "user_id"}, "missing user_id"),
        ({k: v for k, v in GOOD.items() if k != "transaction_id"}, "missing transaction_id"),
        ({**GOOD, "user_id": None}, "null user_id"),
        ({**GOOD, "amount": 1e20}, "amount out of range"),
        ({**GOOD, "amount": -1e300}, "amount out of range"),
        ({**GOOD, "amount": "many"}, "bad amount"),
        ({**GOOD, "amount": None}, "bad amount"),
        ('{"user_id":"u","amount":NaN,"timestamp":1,"transaction_id":"t"}', "bad amount"),
        ({**GOOD, "amount": "Infinity"}, "bad amount"),
        ({**GOOD, "timestamp": "soon"}, "bad timestamp"),
        ({**GOOD, "timestamp": 10**18}, "bad timestamp"),
    ],
)
def test_bad_events_are_set_aside(spark, value, error):
    both = parsed(spark, value, GOOD)
    assert [r.error for r in rejected_events(both).collect()] == [error]
    assert good_events(both).count() == 1


def test_fail_stops_the_job(spark):
    raw = spark.createDataFrame([("nonsense",)], "value string")
    assert parse_events(raw).count() == 0
    with pytest.raises(Exception, match="not a JSON object"):
        parse_events(raw, on_error="fail").collect()
    with pytest.raises(ValueError):
        parse_events(raw, on_error="ignore")


def test_messages_and_parse_are_inverse(spark):
    event = good_events(parsed(spark, {**GOOD, "product_name": None, "category": "a \"b\" \\ ü"}))
    again = good_events(parse(event_messages(event)))
    assert again.collect() == event.collect()


def test_text_times_become_millis(spark):
    facts = good_events(parsed(spark, GOOD)).withColumn("event_time", F.lit("2024-05-06 07:08:09.123"))
    assert json.loads(event_messages(facts).first().value)["timestamp"] == 1714979289123
