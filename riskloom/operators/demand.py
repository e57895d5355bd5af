"""Staging -> per-SKU demand signals (daily demand, running balance, windows)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import DEMAND_TYPES, INBOUND_TYPES, safe_divide
from riskloom.operators.clock import AS_OF_COL, clock, in_window
from riskloom.sources.fixtures import run_ts_lit


def _since(as_of: dt.date | None, days: int):
    """Inclusive N-day window [as_of - N, as_of] (N+1 calendar dates, replayable)."""
    return in_window("transaction_date", as_of, days)


def daily_demand(staged: DataFrame, as_of: dt.date | None, days: int = 120) -> DataFrame:
    """(sku, day) demand units, receipt units and transaction count.

    The date filter reaches the scan; the aggregate runs partial (map-side)
    then final, so each input partition ships at most one row per (sku, day).
    ``staged`` is unique by transaction_id, so COUNT equals COUNT DISTINCT
    without the extra expand of a distinct aggregate.
    """
    _, keys = clock(as_of)
    return _daily(staged.where(_since(as_of, days)), keys)


def _daily(staged: DataFrame, keys: list[str]) -> DataFrame:
    t = F.col("transaction_type")
    n = F.count("transaction_id") if "transaction_id" in staged.columns else F.count(F.lit(1))
    units = F.abs(F.col("signed_quantity"))
    return (staged.groupBy(*keys, "sku_id", "transaction_date")
            .agg(F.sum(F.when(t.isin(*DEMAND_TYPES), units).otherwise(F.lit(0))).alias("daily_demand_units"),
                 F.sum(F.when(t.isin(*INBOUND_TYPES), units).otherwise(F.lit(0))).alias("daily_receipt_units"),
                 n.alias("daily_transaction_count")))


def daily_demand_all(staged: DataFrame) -> DataFrame:
    """(sku, day) totals over all dates: the as-of-independent part, expanded per snapshot later.

    Staged rows always have a transaction_id; a table of them may leave it out.
    """
    return _daily(staged, [])


def running_inventory(daily: DataFrame) -> DataFrame:
    """Running balance = cumulative receipts - demand per SKU, by date.

    Partitioned by sku over pre-aggregated daily rows: a window partition
    holds at most one row per calendar day in the warm-up range, whatever
    the raw volume of the SKU.
    """
    keys = [AS_OF_COL] if AS_OF_COL in daily.columns else []
    w = (Window.partitionBy(*keys, "sku_id").orderBy("transaction_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumn(
        "running_inventory_balance",
        F.sum(F.col("daily_receipt_units") - F.col("daily_demand_units")).over(w))


def demand_signals(staged: DataFrame, as_of: dt.date | None, run_ts: dt.datetime, run_id: str,
                   mode: str = "windowed") -> DataFrame:
    """One row per active SKU: rolling demand, variability, stockouts, coverage.

    mode="windowed" applies the 7-day window to demand_7d; mode="as_written"
    reproduces the original table, where demand_7d equals demand_90d.
    ``as_of=None`` computes every snapshot carried in the ``as_of`` column.
    """
    if mode not in ("windowed", "as_written"):
        raise ValueError(f"unknown mode {mode!r}")
    return signals_from_daily(daily_demand(staged, as_of, 120), as_of, run_ts, run_id, mode)


def signals_from_daily(daily: DataFrame, as_of: dt.date | None, run_ts: dt.datetime, run_id: str,
                       mode: str = "windowed") -> DataFrame:
    """Demand signals from (sku, day) rows of the 120-day warm-up range (per snapshot if as_of is None)."""
    daily = daily.where(_since(as_of, 120))
    running = running_inventory(daily)
    d = F.col("transaction_date")
    dem = F.col("daily_demand_units")
    bal = F.col("running_inventory_balance")
    a, keys = clock(as_of)
    in30 = d >= F.date_sub(a, 30)
    in7 = d >= F.date_sub(a, 7)
    d7 = F.sum(F.when(in7, dem).otherwise(F.lit(0))) if mode == "windowed" else F.sum(dem)
    # The 90-day filter sits above the running sum: the warm-up days stay in the balance.
    agg = (running.where(_since(as_of, 90))
           .groupBy(*keys, "sku_id")
           .agg(d7.alias("demand_7d"),
                F.sum(F.when(in30, dem).otherwise(F.lit(0))).alias("demand_30d"),
                F.sum(dem).alias("demand_90d"),
                safe_divide(F.stddev_samp(F.when(in30, dem)), F.avg(F.when(in30, dem))).alias("cv"),
                F.count_if((bal <= 0) & in30).alias("stockout_days_30d"),
                F.max(F.when(bal <= 0, F.lit(1)).otherwise(F.lit(0))).alias("stockout_flag"),
                safe_divide(F.max(bal), F.avg(F.when(in7, dem))).alias("dos"),
                F.count(d).alias("active_days_90d"),
                F.max(d).alias("last_transaction_date")))
    return (agg.where((F.col("demand_90d") > 0) | (F.col("active_days_90d") > 0))
            .select(
                "sku_id",
                a.alias("signal_date"),
                F.col("demand_7d").cast("long").alias("demand_7d"),
                F.col("demand_30d").cast("long").alias("demand_30d"),
                F.col("demand_90d").cast("long").alias("demand_90d"),
                F.coalesce(F.col("cv"), F.lit(0.0)).alias("demand_cv_30d"),
                F.col("stockout_days_30d").cast("long").alias("stockout_days_30d"),
                F.col("stockout_flag").cast("int").alias("stockout_flag"),
                F.coalesce(F.col("dos").cast("double"), F.lit(0.0)).alias("days_of_supply"),
                F.col("active_days_90d").cast("long").alias("active_days_90d"),
                "last_transaction_date",
                F.datediff(a, F.col("last_transaction_date")).cast("long")
                .alias("days_since_last_activity"),
                safe_divide(F.col("demand_7d"), F.col("demand_30d") - F.col("demand_7d"))
                .cast("double").alias("demand_acceleration_ratio"),
                run_ts_lit(run_ts).alias("computed_at"),
                F.lit(run_id).alias("pipeline_run_id"),
            ))
