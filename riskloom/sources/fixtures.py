"""Adapter: the driver's TPC-H-like tables mapped onto the ERP inputs.

The mapping is the one in FIXTURES.md §2 (raw inventory transactions,
purchase-order receipts, event messages). It is a pure projection/join of
the driver tables, so its work grows with them; every row is kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Reference clock of the fixture (FIXTURES.md §2).
AS_OF = dt.date(2001, 8, 1)
RUN_TS = dt.datetime(2001, 8, 1, 6, 0, 0)
RUN_ID = "pipeline-20010801-060000"
SKU_MOD = 50

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_ts_lit(ts: dt.datetime = RUN_TS) -> Column:
    """Run timestamp as a wall-clock (NTZ) literal, comparable across engines."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _sku_expr(partkey: Column, sku_mod: int | None) -> Column:
    k = partkey if sku_mod is None else partkey % F.lit(sku_mod)
    return F.concat(F.lit("SKU-"), k.cast("string"))


def raw_inventory_transactions(lineitem: DataFrame, sku_mod: int | None = SKU_MOD) -> DataFrame:
    """lineitem -> raw ERP inventory transactions (dirty on purpose: NULLs, zeros, case)."""
    l = F.col
    ttype = (F.when(l("l_linenumber") == 7, F.lit("cycle_count"))
             .when((l("l_returnflag") == "R") & (l("l_linestatus") == "O"), F.lit(" Receipt "))
             .when(l("l_returnflag") == "R", F.lit("ADJUSTMENT_IN"))
             .when((l("l_returnflag") == "A") & (l("l_linestatus") == "O"), F.lit("shipment"))
             .when(l("l_returnflag") == "A", F.lit("Consumption"))
             .when(l("l_linestatus") == "O", F.lit("transfer_out"))
             .otherwise(F.lit("adjustment_out")))
    qty = F.round(l("l_quantity"), 0).cast("long")
    return lineitem.select(
        F.concat(l("l_orderkey").cast("string"), F.lit("-"), l("l_linenumber").cast("string"))
        .alias("transaction_id"),
        F.when(l("l_partkey") % 97 == 0, F.lit(None).cast("string"))
        .otherwise(_sku_expr(l("l_partkey"), sku_mod)).alias("sku_id"),
        F.when(l("l_suppkey") % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("V-"), (l("l_suppkey") % 10).cast("string"))).alias("vendor_id"),
        F.concat(F.lit("WH-"), (l("l_linenumber") % 3).cast("string")).alias("warehouse_id"),
        F.when(l("l_quantity") == 50, F.lit(0).cast("long")).otherwise(qty).alias("quantity"),
        ttype.alias("transaction_type"),
        F.try_divide(l("l_extendedprice"), l("l_quantity")).alias("unit_cost"),
        l("l_shipdate").alias("transaction_timestamp"),
        F.lit("sage100").alias("source_system"),
        F.lit("lineitem.parquet").alias("source_file"),
        l("l_extendedprice").alias("tie_key"),
    )


# Order lines that a task joins; lines up to which Spark's own choice of a join is left to it.
LINES_PER_TASK = 500_000
SMALL_JOIN = 8 * LINES_PER_TASK


def sized_purchase_order_receipts(lineitem: DataFrame, orders: DataFrame, sku_mod: int | None = SKU_MOD,
                                  lines_per_task: int = LINES_PER_TASK, small: int = SMALL_JOIN) -> DataFrame:
    """``purchase_order_receipts`` of large tables, joined in as many tasks as the lines ask for.

    A sort-merge join sorts whole shuffle partitions, which spill when those
    are large. Here both sides are dealt by order key to tasks of a bounded size.
    """
    n = lineitem.count()  # Parquet answers from file footers
    if n > small:
        tasks = -(-n // lines_per_task)
        lineitem = lineitem.repartition(tasks, "l_orderkey")
        orders = orders.repartition(tasks, "o_orderkey")
    return purchase_order_receipts(lineitem, orders, sku_mod)


def purchase_order_receipts(lineitem: DataFrame, orders: DataFrame,
                            sku_mod: int | None = SKU_MOD) -> DataFrame:
    """lineitem x orders -> PO receipt rows (lead times derived arithmetically)."""
    l = F.col
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    od = orders.select("o_orderkey", F.to_date("o_orderdate").alias("po_date"))
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.concat(l("l_orderkey").cast("string"), F.lit("-"), l("l_linenumber").cast("string"))
        .alias("po_id"),
        F.concat(F.lit("V-"), (l("l_suppkey") % 10).cast("string")).alias("vendor_id"),
        _sku_expr(l("l_partkey"), sku_mod).alias("sku_id"),
        l("po_date"),
        F.date_add(l("po_date"), (F.lit(35) + l("l_suppkey") % 15).cast("int")).alias("expected_date"),
        # Every 23rd order line is still open: no receipt yet.
        F.when((l("l_orderkey") + l("l_linenumber")) % 23 != 0, F.date_add(
            l("po_date"), (F.lit(1) + (l("l_partkey") * 7 + l("l_suppkey") * 13 + l("l_linenumber")) % 45)
            .cast("int"))).alias("receipt_date"),
        l("l_orderkey").alias("order_key"),
    )


# Fixed value: receipts later than this many days before the as-of date come with the second batch.
LATE_DAYS = 60


def po_batches(po: DataFrame, as_of: dt.date = AS_OF) -> list[DataFrame]:
    """Purchase orders as they come in: all of them with the receipts known by then, later those with late receipts."""
    late = F.col("receipt_date") > F.lit(as_of - dt.timedelta(days=LATE_DAYS))
    return [po.withColumn("receipt_date", F.when(~late, F.col("receipt_date"))), po.where(late)]


def event_messages(events: DataFrame) -> DataFrame:
    """events -> message envelopes (topic, attribute type, JSON text, attempts).

    Works unchanged on a static or a streaming DataFrame.
    """
    l = F.col
    topic = (F.when(l("user_id") % 3 == 0, F.lit("erp-transactions"))
             .when(l("user_id") % 3 == 1, F.lit("inventory-events"))
             .otherwise(F.lit("order-events")))
    et = l("event_type")

    def pick(a, b, c, d):
        return (F.when(et == "purchase", F.lit(a)).when(et == "view", F.lit(b))
                .when(et == "click", F.lit(c)).otherwise(F.lit(d)))

    etype = (F.when(l("user_id") % 3 == 0, pick("po_created", "po_received", "invoice_posted", "price_changed"))
             .when(l("user_id") % 3 == 1, pick("pick", "putaway", "cycle_count", "adjustment"))
             .otherwise(pick("order_placed", "order_shipped", "order_delayed", "order_cancelled")))
    is_err = et == "error"
    attr_type = (F.when(is_err & (l("event_id") % 4 == 0), F.lit("pick"))
                 .when(is_err | (l("event_id") % 5 == 0), F.lit(None).cast("string"))
                 .otherwise(etype))
    sku = F.concat(F.lit("SKU-"), (l("user_id") % 50).cast("string"))
    data = (F.when(is_err & (l("event_id") % 2 == 0), F.lit('{"id": '))
            .when(is_err, F.concat(F.lit('{"sku_id":"'), sku, F.lit('"}')))
            .otherwise(F.concat(
                F.lit('{"transaction_id":"T-'), l("event_id").cast("string"),
                F.lit('","sku_id":"'), sku,
                F.lit('","quantity":'), F.floor(l("value")).cast("long").cast("string"),
                F.lit(',"event_type":"'), etype, F.lit('"}'))))
    return events.select(
        F.concat(F.lit("M-"), l("event_id").cast("string")).alias("message_id"),
        topic.alias("topic"),
        attr_type.alias("attr_event_type"),
        (l("event_id") % 7).cast("int").alias("delivery_attempt"),
        l("ts").alias("publish_time"),
        data.alias("data"),
    ).withColumn(
        "attributes",
        F.when(l("attr_event_type").isNotNull(),
               F.create_map(F.lit("event_type"), l("attr_event_type")))
        .otherwise(F.create_map().cast("map<string,string>")),
    )


def with_redeliveries(messages: DataFrame) -> DataFrame:
    """Redeliver every tenth message once more (exercises stream dedup)."""
    again = messages.where(F.substring_index(F.col("message_id"), "-", -1).cast("long") % 10 == 0)
    return messages.unionByName(again)
