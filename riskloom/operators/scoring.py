"""Rule-based delay-risk scoring over the latest feature snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import HIGH_BAND, MEDIUM_BAND, risk_level
from riskloom.sources.fixtures import run_ts_lit


def read_latest_snapshot(df: DataFrame, date_col: str = "feature_date",
                         cols: Sequence[str] | None = None, on_date: dt.date | None = None) -> DataFrame:
    """Rows of the newest (or the given) snapshot date.

    ``col = (SELECT MAX(col) ...)`` is an uncorrelated scalar subquery: it runs
    once, and on a table partitioned by ``date_col`` it becomes a partition
    filter, so only the newest partition is read.
    """
    if on_date is not None:
        out = df.where(F.col(date_col) == F.lit(on_date))
    else:
        out = df.where(F.col(date_col) == df.select(F.max(date_col)).scalar())
    return out.select(*cols) if cols else out


def delay_risk_scores(features: DataFrame, run_ts: dt.datetime, high: float = HIGH_BAND,
                      medium: float = MEDIUM_BAND) -> DataFrame:
    latest = read_latest_snapshot(features)
    return latest.select(
        "sku_id", "vendor_id",
        F.col("delay_risk_score").alias("risk_score"),
        risk_level("delay_risk_score", high, medium).alias("risk_level"),
        "supply_risk_flag", "days_of_supply", "lead_time_p90",
        F.col("feature_date").alias("score_date"),
        run_ts_lit(run_ts).alias("scored_at"),
    )
