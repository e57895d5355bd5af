"""Demand signals + vendor map + lead times -> SKU risk feature snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import risk_score, safe_divide, supply_risk_flag
from riskloom.operators.clock import AS_OF_COL
from riskloom.operators.leadtime import sku_vendor_map, vendor_lead_times
from riskloom.sources.fixtures import run_ts_lit

FEATURE_SCHEMA_VERSION = "v1.0"
# Defaults when a SKU has no lead-time history.
DEFAULT_P50 = 14
DEFAULT_P90 = 21


def sku_risk_features(signals: DataFrame, staged: DataFrame, po: DataFrame, as_of: dt.date | None,
                      run_ts: dt.datetime, run_id: str) -> DataFrame:
    """Feature row per SKU; ``staged`` / ``po`` may be rows or their daily pre-aggregates."""
    return features_from_parts(signals, sku_vendor_map(staged, as_of), vendor_lead_times(po, as_of),
                               as_of, run_ts, run_id)


def features_from_parts(signals: DataFrame, svm: DataFrame, vlt: DataFrame, as_of: dt.date | None,
                        run_ts: dt.datetime, run_id: str) -> DataFrame:
    """Feature row per SKU of the as-of snapshot (or of every snapshot if ``as_of`` is None).

    All three inputs are aggregated to SKU or (vendor, sku) grain before the
    two left joins; AQE picks broadcast or sort-merge from runtime sizes.
    """
    if as_of is None:
        d = signals.alias("d")
        on_svm = (F.col("d.sku_id") == F.col("svm.sku_id")) & (F.col("d.signal_date") == F.col(f"svm.{AS_OF_COL}"))
        on_vlt = (F.col("d.signal_date") == F.col(f"vlt.{AS_OF_COL}"))
        fdate = F.col("d.signal_date")
    else:
        d = signals.where(F.col("signal_date") == F.lit(as_of)).alias("d")
        on_svm = F.col("d.sku_id") == F.col("svm.sku_id")
        on_vlt = F.lit(True)
        fdate = F.lit(as_of)
    j = (d.join(svm.alias("svm"), on_svm, "left")
         .join(vlt.alias("vlt"), (F.col("d.sku_id") == F.col("vlt.sku_id"))
               & (F.col("svm.vendor_id") == F.col("vlt.vendor_id")) & on_vlt, "left"))
    late = F.coalesce(F.col("vlt.late_delivery_rate"), F.lit(0.0))
    p90 = F.coalesce(F.col("vlt.lead_time_p90"), F.lit(DEFAULT_P90).cast("long"))
    return j.select(
        F.col("d.sku_id").alias("sku_id"),
        F.col("svm.vendor_id").alias("vendor_id"),
        fdate.alias("feature_date"),
        "d.demand_7d", "d.demand_30d", "d.demand_90d", "d.demand_cv_30d",
        "d.demand_acceleration_ratio",
        "d.days_of_supply", "d.stockout_flag", "d.stockout_days_30d", "d.days_since_last_activity",
        F.coalesce(F.col("vlt.lead_time_p50"), F.lit(DEFAULT_P50).cast("long")).alias("lead_time_p50"),
        p90.alias("lead_time_p90"),
        late.alias("late_delivery_rate"),
        F.coalesce(F.col("vlt.po_count_90d"), F.lit(0).cast("long")).alias("po_count_90d"),
        safe_divide(F.col("d.demand_30d"), F.col("d.days_of_supply")).alias("demand_pressure_ratio"),
        supply_risk_flag("d.stockout_flag", "d.demand_acceleration_ratio", late,
                         "d.days_of_supply", p90).alias("supply_risk_flag"),
        risk_score(late, "d.stockout_days_30d", "d.days_of_supply", "d.demand_cv_30d")
        .alias("delay_risk_score"),
        run_ts_lit(run_ts).alias("computed_at"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(FEATURE_SCHEMA_VERSION).alias("feature_schema_version"),
    )
