"""Upsert: newest versions, only touched partitions, moved keys, repeatable; the purchase-order layer in the chain."""

import datetime as dt
import os

from pyspark.sql import functions as F

from riskloom.operators.leadtime import vendor_lead_times
from riskloom.operators.staging import stage_purchase_order_receipts
from riskloom.plans.pipeline import run_pipeline, upsert_purchase_orders
from riskloom.session import shared_dir as shared_uri
from riskloom.sources.upsert import upsert


def shared_dir(spark, name):
    """A local path: the tests look at the files themselves."""
    return shared_uri(spark, name).removeprefix("file:")


def put(spark, batch, path):
    return upsert(spark, batch, path, "id", [F.col("version").desc()], ["part"])


def rows(spark, *data):
    return spark.createDataFrame(data, "id long, version long, part string, v string")


def table(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "version", "part", "v").collect()), key=repr)


def files(path, part):
    folder = f"{path}/part={part}"
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) if os.path.exists(folder) else []


def test_only_touched_partitions_are_replaced(spark):
    path = shared_dir(spark, "upsert")
    first = rows(spark, (1, 1, "a", "x"), (1, 0, "a", "old"), (2, 1, "a", "x"), (3, 1, "b", "x"), (4, 1, "c", "x"), (5, 1, None, "x"))
    assert put(spark, first, path).first().asDict() == {
        "rows_in": 5, "inserted": 5, "updated": 0, "unchanged": 0, "partitions_rewritten": 4, "partitions_removed": 0}
    untouched = files(path, "c")
    second = rows(spark, (1, 2, "a", "new"), (2, 0, "a", "late"), (3, 2, "a", "moved"), (5, 2, None, "y"), (6, 1, "d", "z"))
    assert put(spark, second, path).first().asDict() == {
        "rows_in": 5, "inserted": 1, "updated": 3, "unchanged": 1, "partitions_rewritten": 3, "partitions_removed": 1}
    want = sorted([(1, 2, "a", "new"), (2, 1, "a", "x"), (3, 2, "a", "moved"), (4, 1, "c", "x"), (5, 2, None, "y"), (6, 1, "d", "z")],
                  key=repr)
    assert table(spark, path) == want
    assert files(path, "c") == untouched and not os.path.exists(f"{path}/part=b")
    again = put(spark, second, path).first()
    assert (again.inserted, again.updated, again.unchanged) == (0, 0, 5) and table(spark, path) == want


def test_empty_batch(spark):
    path = shared_dir(spark, "upsert")
    put(spark, rows(spark, (1, 1, "a", "x")), path)
    none = put(spark, rows(spark, (1, 1, "a", "x")).where("id > 5"), path).first()
    assert none.rows_in == 0 and none.partitions_rewritten == 0
    assert table(spark, path) == [(1, 1, "a", "x")]


def po(spark, *data):
    return spark.createDataFrame(data, "po_id string, vendor_id string, sku_id string, po_date date, expected_date date, receipt_date date")


def test_late_receipt_closes_an_open_order(spark):
    path = shared_dir(spark, "po")
    d = dt.date
    order = ("P1", "V", "S", d(2001, 5, 2), d(2001, 6, 1))
    other = ("P2", "V", "S", d(2001, 6, 2), d(2001, 7, 1), d(2001, 6, 12))
    upsert_purchase_orders(spark, po(spark, (*order, None), other, other), path)
    before = vendor_lead_times(spark.read.parquet(path), d(2001, 7, 1)).first()
    assert (before.po_count_90d, before.lead_time_p90, before.late_delivery_rate) == (2, 10, 0.0)
    got = upsert_purchase_orders(spark, po(spark, (*order, d(2001, 6, 20)), (*order, None)), path).first()
    assert (got.inserted, got.updated, got.partitions_rewritten) == (0, 1, 1)
    after = vendor_lead_times(spark.read.parquet(path), d(2001, 7, 1)).first()
    assert (after.po_count_90d, after.lead_time_p90, after.late_delivery_rate) == (2, 49, 0.5)


def test_chain_continues_the_layer_with_a_later_batch(spark, x001):
    from riskloom.sources.fixtures import po_batches
    first, late = po_batches(x001.raw_po, x001.as_of)
    out, args = shared_dir(spark, "chain"), (x001.as_of, x001.run_ts, x001.run_id)
    run_pipeline(spark, x001.raw, first, out, *args)
    open_orders = spark.read.parquet(f"{out}/staging/purchase_orders").where("receipt_date is null").count()
    run_pipeline(spark, x001.raw, late, out, *args)
    layer = spark.read.parquet(f"{out}/staging/purchase_orders").drop("po_month")
    want = stage_purchase_order_receipts(x001.raw_po)
    assert layer.select(*want.columns).exceptAll(want).isEmpty() and layer.count() == want.count()
    assert layer.where("receipt_date is null").count() < open_orders
    features = spark.read.parquet(f"{out}/ml_features/sku_risk_features")
    assert features.select("sku_id", "po_count_90d", "late_delivery_rate").exceptAll(
        x001.features.select("sku_id", "po_count_90d", "late_delivery_rate")).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sized_dedup_sorts_nothing_before_the_shuffle(spark):
    from riskloom.operators.staging import dedup_latest, dedup_sized
    # Every key twice, one key hot, one NULL.
    df = spark.range(4000).select(
        F.when(F.col("id") >= 3900, F.lit(None)).when(F.col("id") >= 3000, F.lit("hot"))
        .otherwise((F.col("id") % 1500).cast("string")).alias("k"), F.col("id").alias("v"))
    order = [F.col("v").desc()]
    want = sorted(map(tuple, dedup_latest(df, "k", order).collect()), key=repr)
    for size in (10, 100, 800, 5000):
        assert sorted(map(tuple, dedup_sized(df, "k", order, rows_per_task=size).collect()), key=repr) == want
    even = df.where("k <> 'hot'")
    sized, plain = plan(dedup_sized(even, "k", order, rows_per_task=500)), plan(dedup_latest(even, "k", order))
    first_shuffle = lambda p: p[:p.rindex("Exchange")].count("Sort") == p.count("Sort")
    assert first_shuffle(sized) and not first_shuffle(plain)
    hot = plan(dedup_sized(df, "k", order, rows_per_task=500))
    assert hot.count("REPARTITION_BY_NUM") == 1 and "Union" in hot  # the hot key keeps the plan that cuts it first


def test_a_first_batch_is_written_once(spark, monkeypatch):
    from riskloom.sources import upsert as module
    stored = []
    keep = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: stored.append(name) or keep(df, name))
    path = shared_dir(spark, "upsert")
    got = put(spark, rows(spark, (1, 1, "a", "x"), (1, 2, "b", "y"), (2, 1, None, "x")), path).first()
    assert (got.rows_in, got.partitions_rewritten) == (2, 2) and not stored
    empty = shared_dir(spark, "upsert")
    assert put(spark, rows(spark, (1, 1, "a", "x")).where("id > 5"), empty).first().rows_in == 0


def test_the_layer_joins_its_sources_once(spark, monkeypatch):
    from riskloom.plans import context, stored
    monkeypatch.setattr(stored, "_TABLES", {})
    read = []
    upsert_po = context.upsert_purchase_orders
    monkeypatch.setattr(context, "upsert_purchase_orders", lambda s, b, p: read.append(plan(b)) or upsert_po(s, b, p))
    assert context.Inputs(spark, "/root/testdata/sf0.001").po.count() > 0
    assert len(read) == 2 and not any("Join" in p for p in read)


def test_large_sources_are_joined_in_sized_tasks(spark):
    from riskloom.sources import fixtures as fx
    li, od = (fx.table(spark, "/root/testdata/sf0.001", t) for t in ("lineitem", "orders"))
    sized = fx.sized_purchase_order_receipts(li, od, lines_per_task=1000, small=0)
    want = fx.purchase_order_receipts(li, od)
    assert sized.exceptAll(want).isEmpty() and sized.count() == want.count()
    p = plan(sized)
    tasks = -(-li.count() // 1000)
    assert p.count("REPARTITION_BY_NUM") == 2 and p.count(f", {tasks}), REPARTITION_BY_NUM") == 2
    assert plan(fx.sized_purchase_order_receipts(li, od)).count("REPARTITION_BY_NUM") == 0


def test_derived_columns_do_not_move(spark, monkeypatch):
    from riskloom.operators import staging
    from riskloom.sources import sinks, upsert as module
    moved = []
    sized = module.dedup_sized
    monkeypatch.setattr(module, "dedup_sized", lambda df, *a: moved.append(df.columns) or sized(df, *a))
    path = shared_dir(spark, "po")
    d = dt.date
    batch = po(spark, ("P1", "V", "S", d(2001, 5, 2), d(2001, 6, 1), None), ("P1", "V", "S", d(2001, 5, 2), d(2001, 6, 1), d(2001, 5, 1)),
               ("P2", "V", "S", d(2001, 6, 2), d(2001, 7, 1), d(2001, 6, 12)))
    upsert_purchase_orders(spark, batch, path)
    upsert_purchase_orders(spark, batch.where("po_id = 'P2'"), path)
    names = set(staging.po_layer_derived())
    assert len(moved) == 3 and not any(names & set(c) for c in moved)
    got = {r.po_id: (r.lead_days, r.receipt_before_po, r.receipt_timestamp, r.po_month) for r in spark.read.parquet(path).collect()}
    assert got == {"P1": (-1, True, dt.datetime(2001, 5, 1), d(2001, 5, 1)), "P2": (10, False, dt.datetime(2001, 6, 12), d(2001, 6, 1))}
    df = spark.range(10).select("id", (F.col("id") % 2).alias("part"), (F.col("id") * 2).alias("twice"))
    out = sinks.write_table(df, shared_dir(spark, "derived"), partition_by=("part",), derived={"twice": F.col("id") * 2})
    back = spark.read.parquet(out)
    assert sorted(map(tuple, back.select("id", "part", "twice").collect())) == [(i, i % 2, 2 * i) for i in range(10)]
