"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Each entry wires one operator of SURVEY §2 to the driver tables through
the fixture adapter and returns a flat, comparable DataFrame (floating
columns rounded to 6 places for the cross-engine check only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import columns as fc
from riskloom.operators import demand as dm
from riskloom.operators import leadtime as lt
from riskloom.operators import scoring as sc
from riskloom.operators import staging as st
from riskloom.plans.context import Inputs, rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str, exact: tuple[str, ...] = ()):
    """Register ``fn(Inputs) -> DataFrame`` under ``key``.

    Floating columns are rounded to 6 places except ``exact`` ones: row-level
    arithmetic is bit-identical across engines and must not be re-rounded.
    """
    def deco(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(Inputs(spark, sf_dir)), keep=exact)
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return fn
    return deco


# --------------------------------------------------------------------- staging
@query("stage_inventory", exact=("unit_cost",))
def _stage_inventory(x: Inputs) -> DataFrame:
    return x.staged


@query("dedup_latest", exact=("tie_key",))
def _dedup_latest(x: Inputs) -> DataFrame:
    """Latest row per transaction id over the whole raw table (no quality filter)."""
    raw = x.raw.where(F.col("transaction_id").isNotNull())
    out = st.dedup_latest(raw, "transaction_id",
                          [F.col("transaction_timestamp").desc(), F.col("tie_key").desc()])
    return out.select("transaction_id", "sku_id", "quantity", "transaction_timestamp", "tie_key")


@query("signed_quantity")
def _signed_quantity(x: Inputs) -> DataFrame:
    """Signed-quantity rule per transaction type, summed over all raw rows."""
    s = x.raw.select(fc.normalise_text("transaction_type").alias("transaction_type"),
                     fc.signed_quantity("transaction_type", "quantity").alias("sq"))
    return s.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.sum("sq").alias("sum_signed_quantity"))


@query("stage_po_receipts")
def _stage_po(x: Inputs) -> DataFrame:
    return st.stage_purchase_order_receipts(x.raw_po)


# ---------------------------------------------------------------------- demand
@query("daily_demand")
def _daily_demand(x: Inputs) -> DataFrame:
    return dm.daily_demand(x.recent_staged, x.as_of, 120)


@query("running_inventory")
def _running_inventory(x: Inputs) -> DataFrame:
    return dm.running_inventory(dm.daily_demand(x.recent_staged, x.as_of, 120))


@query("demand_signals")
def _demand_signals(x: Inputs) -> DataFrame:
    return x.signals


@query("demand_signals_as_written")
def _demand_signals_as_written(x: Inputs) -> DataFrame:
    return dm.demand_signals(x.recent_staged, x.as_of, x.run_ts, x.run_id, mode="as_written")


# -------------------------------------------------------------------- leadtime
@query("vendor_lead_times")
def _vendor_lead_times(x: Inputs) -> DataFrame:
    return lt.vendor_lead_times(x.po, x.as_of)


@query("vendor_lead_times_sketch")
def _vendor_lead_times_sketch(x: Inputs) -> DataFrame:
    """The approximate-quantile form (mergeable sketches), as the original table computes it."""
    return lt.vendor_lead_times(x.po, x.as_of, method="sketch")


@query("sku_vendor_map")
def _sku_vendor_map(x: Inputs) -> DataFrame:
    return lt.sku_vendor_map(x.recent_staged, x.as_of)


# -------------------------------------------------------------------- features
@query("sku_risk_features")
def _sku_risk_features(x: Inputs) -> DataFrame:
    return x.features


@query("supply_risk_flag")
def _supply_risk_flag(x: Inputs) -> DataFrame:
    """Which branch of the ordered flag fires, per SKU."""
    f = x.features
    return f.select("sku_id", "supply_risk_flag", fc.supply_risk_branch().alias("flag_branch"))


@query("risk_score")
def _risk_score(x: Inputs) -> DataFrame:
    f = x.features
    return f.select("sku_id", "late_delivery_rate", "stockout_days_30d", "days_of_supply",
                    "demand_cv_30d", "delay_risk_score")


@query("delay_risk_scores")
def _delay_risk_scores(x: Inputs) -> DataFrame:
    return sc.delay_risk_scores(x.features_table, x.run_ts)


@query("latest_snapshot", exact=("o_totalprice",))
def _latest_snapshot(x: Inputs) -> DataFrame:
    """Newest o_orderdate partition of orders via scalar subquery."""
    o = x.table("orders").withColumn("order_date", F.to_date("o_orderdate"))
    return sc.read_latest_snapshot(o, "order_date", ["o_orderkey", "o_custkey", "o_totalprice", "order_date"])


QUERY_MODULES = ("riskloom.plans.registry_io", "riskloom.plans.registry_stream",
                 "riskloom.plans.registry_ml")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import importlib
    for m in QUERY_MODULES:
        importlib.import_module(m)
    return QUERIES
