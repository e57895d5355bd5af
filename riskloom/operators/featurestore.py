"""Feature store on Spark: entity views, offline sync, bulk lookup, freshness, point-in-time.

The online low-latency store of the original design is re-aimed as a bulk
lookup job: requested ids arrive as a DataFrame and are semi-joined, so
the request list can be as large as the table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.leadtime import vendor_lead_times
from riskloom.operators.scoring import read_latest_snapshot

# Entity definitions (id column and feature columns).
ENTITIES: dict[str, dict] = {
    "sku": {"id": "sku_id",
            "features": ["demand_7d", "demand_30d", "demand_90d", "stockout_flag", "days_of_supply",
                         "delay_risk_score"]},
    "vendor": {"id": "vendor_id",
               "features": ["lead_time_p50", "lead_time_p90", "late_delivery_rate", "po_count_90d"]},
    "sku_ext": {"id": "sku_id", "features": ["stockout_rate", "avg_inventory_days"]},
    "vendor_ext": {"id": "vendor_id", "features": ["on_time_rate", "defect_rate"]},
    "order": {"id": "order_id", "features": ["days_since_order", "requested_lead_time", "backlog_depth"]},
    "customer": {"id": "customer_id", "features": ["order_frequency", "avg_order_value", "payment_risk_score"]},
}
FRESHNESS_MAX_HOURS = 25.0


def entity_sku(features: DataFrame) -> DataFrame:
    f = read_latest_snapshot(features)
    return f.select("sku_id", *[F.col(c).cast("double").alias(c) if c != "stockout_flag" else F.col(c).cast("long")
                                for c in ENTITIES["sku"]["features"]], "feature_date")


def entity_vendor(po: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per vendor (vendor grain, not one row per vendor x SKU)."""
    v = vendor_lead_times(po, as_of, grain=("vendor_id",))
    return v.select("vendor_id", F.col("lead_time_p50").cast("double"), F.col("lead_time_p90").cast("double"),
                    "late_delivery_rate", "po_count_90d", F.lit(as_of).alias("feature_date"))


def entity_vendor_as_written(features: DataFrame) -> DataFrame:
    """The original vendor view: vendor features read from the SKU-grain table (one row per SKU)."""
    f = read_latest_snapshot(features)
    return f.select("vendor_id", "sku_id", F.col("lead_time_p50").cast("double"),
                    F.col("lead_time_p90").cast("double"), "late_delivery_rate", "po_count_90d", "feature_date")


def entity_sku_ext(features: DataFrame) -> DataFrame:
    f = read_latest_snapshot(features)
    return f.select("sku_id", (F.col("stockout_days_30d") / F.lit(30.0)).alias("stockout_rate"),
                    F.col("days_of_supply").alias("avg_inventory_days"), "feature_date")


def entity_vendor_ext(po: DataFrame, lines: DataFrame, as_of: dt.date) -> DataFrame:
    """on_time_rate = 1 - late rate; defect_rate = share of returned lines up to as_of.

    ``lines`` carries vendor_id, a returned flag (0/1) and line_date. Every
    vendor with either is a row: one without a purchase order in the window
    has no on_time_rate (NULL), one without lines a defect_rate of 0.
    """
    v = vendor_lead_times(po, as_of, grain=("vendor_id",))
    d = (lines.where(F.col("line_date") <= F.lit(as_of)).groupBy("vendor_id")
         .agg(F.avg(F.col("returned").cast("double")).alias("defect_rate")))
    return (v.join(d, "vendor_id", "full")
            .select("vendor_id", (F.lit(1.0) - F.col("late_delivery_rate")).alias("on_time_rate"),
                    F.coalesce("defect_rate", F.lit(0.0)).alias("defect_rate"),
                    F.lit(as_of).alias("feature_date")))


def entity_order(orders: DataFrame, po: DataFrame, as_of: dt.date) -> DataFrame:
    """Per order up to as_of: age, longest requested lead time, open orders of its customer.

    ``po``: purchase orders that carry the key of their order (``order_key``).
    """
    o = orders.where(F.to_date("o_orderdate") <= F.lit(as_of)).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"), "o_orderstatus")
    lead = (po.where(F.col("order_key").isNotNull()).groupBy(F.col("order_key").alias("o_orderkey"))
            .agg(F.max(F.datediff("expected_date", "po_date")).alias("requested_lead_time")))
    backlog = (o.where(F.col("o_orderstatus") == "O").groupBy("o_custkey")
               .agg(F.count(F.lit(1)).alias("backlog_depth")))
    return (o.join(lead, "o_orderkey", "left").join(backlog, "o_custkey", "left")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.datediff(F.lit(as_of), "order_date").cast("long").alias("days_since_order"),
                    F.col("requested_lead_time").cast("long").alias("requested_lead_time"),
                    F.coalesce("backlog_depth", F.lit(0)).cast("long").alias("backlog_depth"),
                    F.lit(as_of).alias("feature_date")))


def entity_customer(customers: DataFrame, orders: DataFrame, as_of: dt.date, days: int = 365) -> DataFrame:
    """Orders per 30 days over the last year, average order value, balance-based payment risk."""
    d = F.to_date("o_orderdate")
    recent = (orders.where((d >= F.date_sub(F.lit(as_of), days)) & (d <= F.lit(as_of)))
              .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("aov")))
    c = customers.select("c_custkey", "c_acctbal")
    return (c.join(recent, c.c_custkey == recent.o_custkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    (F.coalesce("n", F.lit(0)) * F.lit(30.0) / F.lit(float(days))).alias("order_frequency"),
                    F.col("aov").alias("avg_order_value"),
                    F.least(F.lit(1.0), F.greatest(F.lit(0.0), -F.col("c_acctbal") / F.lit(1000.0)))
                    .alias("payment_risk_score"),
                    F.lit(as_of).alias("feature_date")))


def sync(entity: str, view: DataFrame, path: str, feature_date: dt.date | None = None) -> DataFrame:
    """Write the chosen (or latest) snapshot to the offline store; report what landed."""
    if entity not in ENTITIES:
        raise ValueError(f"Unknown entity type: {entity}")
    snap = read_latest_snapshot(view, on_date=feature_date)
    (snap.withColumn("entity_type", F.lit(entity)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("entity_type", "feature_date").parquet(path))
    landed = view.sparkSession.read.parquet(path).where(F.col("entity_type") == entity)
    return landed.groupBy("entity_type", "feature_date").agg(F.count(F.lit(1)).alias("records_synced"))


def lookup(entity: str, view: DataFrame, ids: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Features of the requested ids from the latest snapshot; unknown ids are absent."""
    if entity not in ENTITIES:
        raise ValueError(f"Unknown entity type: {entity}")
    key = ENTITIES[entity]["id"]
    feats = list(features or ENTITIES[entity]["features"])
    snap = read_latest_snapshot(view)
    return snap.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi").select(key, *feats)


def freshness(view: DataFrame, now: dt.datetime, max_hours: float = FRESHNESS_MAX_HOURS,
              entity: str = "sku") -> DataFrame:
    """Latest date / computed time, row count, hours stale; an empty table counts as stale."""
    now_lit = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    agg = view.agg(F.max("feature_date").alias("latest_feature_date"),
                   F.max("computed_at").alias("latest_computed_at"),
                   F.count(F.lit(1)).alias("total_entities"))
    secs = F.unix_timestamp(now_lit.cast("timestamp")) - F.unix_timestamp(F.col("latest_computed_at").cast("timestamp"))
    hours = F.round(secs / F.lit(3600.0), 1)
    return agg.select(F.lit(entity).alias("entity_type"), "latest_feature_date", "latest_computed_at",
                      "total_entities", hours.alias("hours_stale"),
                      (F.col("latest_computed_at").isNull() | (hours > F.lit(max_hours))).alias("is_stale"))


def point_in_time(features: DataFrame, labels: DataFrame, key: str, feature_ts: str = "feature_date",
                  label_ts: str = "label_date") -> DataFrame:
    """Attach to each label row the newest feature snapshot with feature_ts <= label_ts.

    An as-of join without pairing rows: the distinct (key, date) points of
    both sides are merged and a running ``last`` carries the newest snapshot
    date forward. That window sees one row per distinct date of a key (not
    per label or feature row), so a hot key stays bounded by its calendar.
    The result is then two equi-joins.
    """
    snaps = features.select(key, F.col(feature_ts).alias("__d")).distinct().withColumn("__snap", F.col("__d"))
    asks = labels.select(key, F.col(label_ts).alias("__d")).distinct().withColumn("__snap", F.lit(None).cast("date"))
    pts = snaps.unionByName(asks)
    w = (Window.partitionBy(key).orderBy(F.col("__d"), F.col("__snap").asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, 0))
    mapping = (pts.withColumn("__asof", F.last("__snap", ignorenulls=True).over(w))
               .groupBy(key, "__d").agg(F.max("__asof").alias("__asof")))
    lab = labels.join(mapping.withColumnRenamed("__d", label_ts), [key, label_ts], "left")
    f = features.withColumnRenamed(feature_ts, "__asof")
    return lab.join(f, [key, "__asof"], "left").withColumnRenamed("__asof", feature_ts)
