"""Vendor lead-time statistics and the SKU -> main vendor map."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.quantiles import histogram_quantiles
from riskloom.operators.clock import clock, in_window

# Fixed value: quantile sketch accuracy (relative error 1/10000).
QUANTILE_ACCURACY = 10000


def _receipt_date(po: DataFrame) -> Column:
    if "receipt_date" in po.columns:
        return F.col("receipt_date").cast("date")
    return F.to_date("receipt_timestamp")


def lead_time_rows(po: DataFrame, as_of: dt.date | None, days: int = 90) -> DataFrame:
    """PO rows of the last ``days`` days with lead and lateness columns (and a weight).

    Accepts raw PO rows or the daily pre-aggregate of ``daily_lead_counts``
    (which carries ``lead_days``, ``n_late`` and ``n_po`` already).
    """
    p = F.col("po_date").cast("date")
    _, keys = clock(as_of)
    if "po_month" in po.columns and as_of is not None:
        # The layer is partitioned by month: only those of the window are read.
        po = po.where(F.col("po_month").between(F.lit((as_of - dt.timedelta(days=days)).replace(day=1)), F.lit(as_of)))
    if "n_po" in po.columns:
        return (po.where(in_window(p, as_of, days))
                .select(*keys, "vendor_id", "sku_id", "lead_days",
                        F.col("n_late").cast("double").alias("is_late"), F.col("n_po").alias("weight")))
    rd = _receipt_date(po)
    return (po.where(in_window(p, as_of, days))
            .select(*keys, "vendor_id", "sku_id",
                    F.datediff(rd, p).alias("lead_days"),
                    F.when(F.datediff(rd, F.col("expected_date").cast("date")) > 0, F.lit(1.0))
                    .otherwise(F.lit(0.0)).alias("is_late"),
                    F.lit(1).cast("long").alias("weight")))


def daily_lead_counts(po: DataFrame) -> DataFrame:
    """(vendor, sku, po_date, lead_days) -> PO count and late count; independent of the as-of date.

    Aggregating before a snapshot expansion turns per-PO rows into
    per-day rows, so the expansion copies days, not orders.
    """
    rd = _receipt_date(po)
    p = F.col("po_date").cast("date")
    late = F.when(F.datediff(rd, F.col("expected_date").cast("date")) > 0, F.lit(1)).otherwise(F.lit(0))
    return (po.select("vendor_id", "sku_id", p.alias("po_date"), F.datediff(rd, p).alias("lead_days"),
                      late.alias("late"))
            .groupBy("vendor_id", "sku_id", "po_date", "lead_days")
            .agg(F.count(F.lit(1)).alias("n_po"), F.sum("late").alias("n_late")))


def vendor_lead_times(po: DataFrame, as_of: dt.date | None, days: int = 90, method: str = "histogram",
                      grain: Sequence[str] = ("vendor_id", "sku_id")) -> DataFrame:
    """p50/p90 lead days, late-delivery rate and PO count per (vendor, sku).

    method="histogram" (default): exact discrete quantiles from per-group
    day histograms (lead times are whole days, so a group has one histogram
    row per distinct lead time, however many POs it holds).
    method="sketch": ``percentile_approx`` sketches, merged after a partial
    aggregate (for measures without a small integer domain).
    """
    rows = lead_time_rows(po, as_of, days)
    _, keys = clock(as_of)
    k = [*keys, *grain]
    if method == "histogram":
        q = histogram_quantiles(rows, k, "lead_days", [0.5, 0.9], ["p50", "p90"],
                                {"late": F.col("is_late")}, weight=F.col("weight"))
        return q.select(*k, F.col("p50").cast("long").alias("lead_time_p50"),
                        F.col("p90").cast("long").alias("lead_time_p90"),
                        (F.col("late") / F.col("__n")).alias("late_delivery_rate"),
                        F.col("__n").cast("long").alias("po_count_90d"))
    if method != "sketch":
        raise ValueError(f"unknown quantile method {method!r}")
    if "n_po" in po.columns:
        raise ValueError("method='sketch' needs one row per PO, not daily counts")
    qa = F.percentile_approx("lead_days", [0.5, 0.9], QUANTILE_ACCURACY)
    return (rows.groupBy(*k)
            .agg(qa[0].cast("long").alias("lead_time_p50"),
                 qa[1].cast("long").alias("lead_time_p90"),
                 F.avg("is_late").alias("late_delivery_rate"),
                 F.count(F.lit(1)).alias("po_count_90d")))


def daily_vendor_counts(staged: DataFrame) -> DataFrame:
    """(sku, vendor, day) -> transaction count; the as-of-independent part of the vendor map."""
    return (staged.where(F.col("vendor_id").isNotNull())
            .groupBy("sku_id", "vendor_id", "transaction_date").agg(F.count(F.lit(1)).alias("n_tx")))


def sku_vendor_map(staged: DataFrame, as_of: dt.date | None, days: int = 90) -> DataFrame:
    """Each SKU's most frequent vendor over the window (ties: smallest vendor_id).

    Accepts staged rows or the ``daily_vendor_counts`` pre-aggregate.

    Counting is a partial/final aggregate; the top-1 window then sees one
    row per (sku, vendor) pair only.
    """
    _, keys = clock(as_of)
    n = F.sum("n_tx") if "n_tx" in staged.columns else F.count(F.lit(1))
    counts = (staged.where(in_window("transaction_date", as_of, days) & F.col("vendor_id").isNotNull())
              .groupBy(*keys, "sku_id", "vendor_id").agg(n.cast("long").alias("transaction_count")))
    w = Window.partitionBy(*keys, "sku_id").orderBy(F.col("transaction_count").desc(), F.col("vendor_id").asc())
    return (counts.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))
