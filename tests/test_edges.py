"""Hand-made edge frames (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions import columns as fc
from riskloom.operators import evaluation as evl
from riskloom.operators import featurestore as fs
from riskloom.operators import quality as qa
from riskloom.operators.demand import demand_signals
from riskloom.operators.leadtime import sku_vendor_map
from riskloom.operators.staging import stage_inventory
from riskloom.streaming import events as ev

AS_OF = dt.date(2001, 8, 1)
RUN_TS = dt.datetime(2001, 8, 1, 6)
RAW = ("transaction_id string, sku_id string, vendor_id string, warehouse_id string, quantity string, "
       "transaction_type string, unit_cost double, transaction_timestamp timestamp_ntz, source_system string, "
       "source_file string, tie_key double")


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def _ts(d):
    return dt.datetime(d.year, d.month, d.day)


def test_ties_broken_by_tie_key(spark):
    t = _ts(AS_OF)
    raw = _raw(spark, [("T1", "S", "V", "W", "5", "receipt", 1.0, t, "s", "f", 1.0),
                       ("T1", "S", "V", "W", "7", "receipt", 1.0, t, "s", "f", 2.0)])
    out = stage_inventory(raw, AS_OF, RUN_TS, "r", tie_keys=("tie_key",)).collect()
    assert len(out) == 1 and out[0].quantity == 7


def test_cast_rounding_and_bad_values(spark):
    t = _ts(AS_OF)
    vals = ["1.5", "-1.5", "2.5", "abc", None, ""]
    raw = _raw(spark, [(f"T{i}", "S", "V", "W", v, "shipment", 1.0, t, "s", "f", 0.0) for i, v in enumerate(vals)])
    got = {r.transaction_id: r.quantity for r in stage_inventory(raw, AS_OF, RUN_TS, "r").collect()}
    assert got == {"T0": 2, "T1": -2, "T2": 3}


def test_single_day_sku_cv_zero_and_zero_demand(spark):
    t = _ts(AS_OF - dt.timedelta(days=2))
    raw = _raw(spark, [("A1", "ONE", "V", "W", "4", "shipment", 1.0, t, "s", "f", 0.0),
                       ("B1", "RCV", "V", "W", "9", "receipt", 1.0, t, "s", "f", 0.0)])
    st = stage_inventory(raw, AS_OF, RUN_TS, "r")
    sig = {r.sku_id: r for r in demand_signals(st, AS_OF, RUN_TS, "r").collect()}
    assert sig["ONE"].demand_cv_30d == 0.0
    assert sig["RCV"].days_of_supply == 0.0 and sig["RCV"].demand_acceleration_ratio is None


def test_vendor_null_and_tie(spark):
    t = _ts(AS_OF)
    raw = _raw(spark, [("1", "S", "V-b", "W", "1", "receipt", 1.0, t, "s", "f", 0.0),
                       ("2", "S", "V-a", "W", "1", "receipt", 1.0, t, "s", "f", 0.0),
                       ("3", "S", None, "W", "1", "receipt", 1.0, t, "s", "f", 0.0),
                       ("4", "S", None, "W", "1", "receipt", 1.0, t, "s", "f", 0.0)])
    m = sku_vendor_map(stage_inventory(raw, AS_OF, RUN_TS, "r"), AS_OF).collect()
    assert [(r.sku_id, r.vendor_id) for r in m] == [("S", "V-a")]


def test_strict_least_null(spark):
    r = spark.range(1).select(fc.strict_least(F.lit(None).cast("double"), F.lit(1.0)).alias("a"),
                              F.least(F.lit(None).cast("double"), F.lit(1.0)).alias("b")).first()
    assert r.a is None and r.b == 1.0


@pytest.mark.parametrize("data,valid,qty,reason", [
    ('{"id": ', False, None, "unparseable_payload"),
    ("{}", False, None, "missing:transaction_id"),
    ('{"transaction_id":"t","sku_id":"s","event_type":"pick","quantity":null}', False, None, "missing:quantity"),
    ('{"transaction_id":"t","sku_id":"s","event_type":"pick","quantity":"x"}', False, None, "bad_quantity"),
    ('{"transaction_id":"t","sku_id":"s","event_type":"pick","quantity":3.7}', True, 3, ""),
    ('{"id":"t","sku_id":"s","transaction_type":"pick","quantity":-2.5}', True, -2, ""),
])
def test_json_payloads(spark, data, valid, qty, reason):
    msgs = spark.createDataFrame([("m", "inventory-events", data, {}, 1, _ts(AS_OF))],
                                 "message_id string, topic string, data string, attributes map<string,string>, "
                                 "delivery_attempt int, publish_time timestamp_ntz")
    r = ev.parse_inventory_events(ev.parse_envelope(msgs), RUN_TS).first()
    assert r.is_valid == valid and r.quantity == qty
    assert reason in r.reject_reasons


def test_non_utf8_payload_falls_back(spark):
    msgs = spark.createDataFrame([("m", "order-events", bytearray(b"\xff\xfe{"), {}, 0, _ts(AS_OF))],
                                 "message_id string, topic string, data binary, attributes map<string,string>, "
                                 "delivery_attempt int, publish_time timestamp_ntz")
    r = ev.validate_events(ev.parse_envelope(msgs)).first()
    assert r.event_type == "unknown" and not r.is_valid and "raw_data" in r.payload


def test_validation_thresholds(spark):
    rows = [(str(i), None if i < 5 else "x", "") for i in range(100)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    rep = {(r.check, r.column): r for r in qa.validate_dataset(df, {"a": "string", "b": "string", "d": "int"},
                                                               ["a", "b", "c"]).collect()}
    assert rep[("null_rate", "b")].severity == "info"          # 5.0 % is allowed
    assert rep[("null_rate", "c")].severity == "error"         # blank strings are missing
    assert rep[("schema_missing", "d")].severity == "error"
    assert rep[("schema_extra", "c")].severity == "warning"
    rows2 = [(str(i), None if i < 51 else "x") for i in range(1000)]
    rep2 = {(r.check, r.column): r for r in qa.validate_dataset(
        spark.createDataFrame(rows2, "a string, b string"), {"a": "string", "b": "string"}, ["b"]).collect()}
    assert rep2[("null_rate", "b")].severity == "error"        # 5.1 %
    empty = qa.validate_dataset(spark.createDataFrame([], "a string"), {"a": "string"}, ["a"])
    assert empty.where("check = 'empty'").count() == 1


@pytest.mark.parametrize("f1,passed", [(0.7199, False), (0.72, False), (0.7499, False), (0.75, True)])
def test_gate(spark, f1, passed):
    g = evl.gate(spark.createDataFrame([(f1,)], "f1_score double")).first()
    assert g.passed is passed


@pytest.mark.parametrize("hours,stale", [(25.0, False), (25.1, True)])
def test_freshness(spark, hours, stale):
    computed = dt.datetime(2001, 8, 1, 6)
    df = spark.createDataFrame([(AS_OF, computed)], "feature_date date, computed_at timestamp_ntz")
    now = computed + dt.timedelta(hours=hours)
    r = fs.freshness(df, now).first()
    assert r.hours_stale == hours and r.is_stale is stale


def test_freshness_empty_is_stale(spark):
    df = spark.createDataFrame([], "feature_date date, computed_at timestamp_ntz")
    assert fs.freshness(df, dt.datetime(2001, 8, 2)).first().is_stale is True


def test_stream_type_map_translates_event_types(spark):
    data = '{"transaction_id":"t","sku_id":"s","event_type":"pick","quantity":4}'
    msgs = spark.createDataFrame([("m", "inventory-events", data, {}, 1, _ts(AS_OF))],
                                 "message_id string, topic string, data string, attributes map<string,string>, "
                                 "delivery_attempt int, publish_time timestamp_ntz")
    env = ev.parse_envelope(msgs)
    plain = ev.parse_inventory_events(env, RUN_TS).first()
    mapped = ev.parse_inventory_events(env, RUN_TS, type_map={"pick": "shipment"}).first()
    assert plain.transaction_type == "pick" and mapped.transaction_type == "shipment"
    assert fc.signed_quantity(F.lit(mapped.transaction_type), F.lit(4)) is not None


def test_dead_letter_replay_recovers_fixed_messages(spark):
    rows = [("m1", "inventory-events", '{"transaction_id":"t1","sku_id":"s","quantity":2}', {}, 5, _ts(AS_OF)),
            ("m2", "inventory-events", '{"transaction_id":"t2","sku_id":"s","quantity":3}', {}, 6, _ts(AS_OF)),
            ("m3", "order-events", '{"id": ', {}, 5, _ts(AS_OF))]
    msgs = spark.createDataFrame(rows, "message_id string, topic string, data string, "
                                       "attributes map<string,string>, delivery_attempt int, "
                                       "publish_time timestamp_ntz")
    v = ev.dead_letter_split(ev.validate_events(ev.parse_envelope(msgs)))
    dead = v.where(F.col("status") == "dead_letter")
    assert dead.count() == 3
    loaded = spark.createDataFrame([("t2",)], "transaction_id string")
    fix = ev.default_type_fix({"inventory-events": "adjustment", "order-events": "order_placed"})
    out = ev.dlq_replay(dead, loaded, fix, "r", RUN_TS).collect()
    assert [(r.transaction_id, r.transaction_type, r.quantity) for r in out] == [("t1", "adjustment", 2)]


def test_vendors_without_an_order_in_the_window_stay(spark):
    import datetime as dt

    from riskloom.operators.featurestore import entity_vendor_ext
    d = dt.date
    po = spark.createDataFrame([("V1", "S", d(2001, 7, 1), d(2001, 7, 20), d(2001, 7, 30)), ("V2", "S", d(2000, 1, 1), d(2000, 1, 9), None)],
                               "vendor_id string, sku_id string, po_date date, expected_date date, receipt_date date")
    lines = spark.createDataFrame([("V2", 1, d(2001, 1, 1)), ("V3", 0, d(2001, 1, 1))], "vendor_id string, returned int, line_date date")
    got = {r.vendor_id: (r.on_time_rate, r.defect_rate) for r in entity_vendor_ext(po, lines, d(2001, 8, 1)).collect()}
    assert got == {"V1": (0.0, 0.0), "V2": (None, 1.0), "V3": (None, 0.0)}
