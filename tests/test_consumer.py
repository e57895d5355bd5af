"""A user handler that raises: its row fails with the error, the batch and the stream go on."""

import json

from riskloom.session import shared_dir
from riskloom.streaming import events as ev
from riskloom.streaming import runner as rn


def messages(spark, *payloads):
    rows = [(f"M{i}", "order-events", 1, None, p, {"event_type": "order_placed"}) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "message_id string, topic string, delivery_attempt int, publish_time timestamp_ntz, "
                                       "data string, attributes map<string,string>")


def make_handler():
    """Made in a function, so that workers get it by value (they can't import this file)."""
    def handler(message):
        value = json.loads(message["payload"])["v"]
        if value < 0:
            raise ValueError(f"negative {value}")
        return value or None  # 0: None, a failure
    return ev.row_handler(handler)


def test_a_raising_row_fails_alone(spark):
    got = ev.consume(messages(spark, '{"v": 1}', '{"v": -3}', '{"v": 0}', '{}', 'no json', '{"w": 1}'), make_handler())
    rows = {r.message_id: (r.status, r.error, r.nack_for_retry) for r in got.collect()}
    assert rows == {"M0": ("processed", None, False), "M1": ("failed", "ValueError: negative -3", True),
                    "M2": ("failed", None, True), "M3": ("invalid", None, True),
                    "M4": ("failed", "KeyError: 'v'", True), "M5": ("failed", "KeyError: 'v'", True)}


def test_stream_goes_on_and_counts_batches(spark):
    path = shared_dir(spark, "consumer")
    for payloads in (['{"v": -1}'] * 3, ['{"v": 2}', '{}'], ['{"v": 5}', '{"v": -1}']):
        messages(spark, *payloads).coalesce(1).write.mode("append").parquet(path)
    schema = messages(spark, "{}").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    counters = rn.consume_counters(stream, lambda b: ev.consume(b, make_handler()), "consumer-counters")
    assert ev.consume_summary(counters).first().asDict() == {"processed": 2, "failed": 4, "invalid": 1, "raised": 4, "batches": 3}


def test_column_handlers_stay(spark):
    from pyspark.sql import functions as F
    got = ev.consume(messages(spark, '{"v": 1}', '{"v": -1}'), lambda v: F.get_json_object("payload", "$.v").cast("int") > 0)
    assert [(r.status, r.error) for r in got.orderBy("message_id").collect()] == [("processed", None), ("failed", None)]
