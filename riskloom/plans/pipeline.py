"""The batch chain raw -> staging, purchase orders -> demand signals -> features -> scores.

Each layer is written (partitioned by its date, clustered by its keys) and
read back before the next step: the written table is the lineage cut, so
a lost executor recomputes from the last layer, not from raw. Row counts
per step are the report; a step below its minimum stops the run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from riskloom.schemas import LAYER_SCHEMAS
from riskloom.operators.demand import demand_signals
from riskloom.operators.features import sku_risk_features
from riskloom.operators.scoring import delay_risk_scores
from riskloom.operators.staging import po_layer_derived, po_layer_rows, po_order, stage_inventory
from riskloom.sources.sinks import write_table
from riskloom.sources.upsert import upsert

# Layer tables, their partition and cluster columns.
LAYERS = {
    "staging": ("staging.inventory_transactions", ("ingestion_date",), ("sku_id", "vendor_id")),
    "purchase_orders": ("staging.purchase_orders", ("po_month",), ("vendor_id", "sku_id")),
    "demand_signals": ("analytics.demand_signals_by_sku", ("signal_date",), ("sku_id",)),
    "sku_risk_features": ("ml_features.sku_risk_features", ("feature_date",), ("sku_id", "vendor_id")),
    "delay_risk_scores": ("analytics.delay_risk_scores", ("score_date",), ()),
}


def _layer_path(out_dir: str, table: str) -> str:
    return f"{out_dir.rstrip('/')}/{table.replace('.', '/')}"


def upsert_purchase_orders(spark: SparkSession, raw_po: DataFrame, path: str) -> DataFrame:
    """Stage a batch of purchase orders and merge it into the layer at ``path``; returns the upsert's counts.

    A batch brings new orders and, later, receipts of orders that were open:
    the newest version of each order stays, and only its months are rewritten.
    """
    _, part, cluster = LAYERS["purchase_orders"]
    rows = po_layer_rows(raw_po).to(LAYER_SCHEMAS["purchase_orders"])
    return upsert(spark, rows, path, "po_id", po_order(), part, cluster, po_layer_derived())


def run_pipeline(spark: SparkSession, raw: DataFrame, po: DataFrame | Sequence[DataFrame], out_dir: str, as_of: dt.date,
                 run_ts: dt.datetime, run_id: str, min_rows: int = 1, tie_keys=("tie_key",)) -> DataFrame:
    """Run the chain; ``po`` is one batch of raw purchase orders or several in the order they came.

    The purchase-order layer at ``out_dir`` is merged into, so a later run
    with just the new batches continues it; the other layers are rebuilt.
    """
    report = []

    def land(step: str, df: DataFrame) -> DataFrame:
        table, part, cluster = LAYERS[step]
        path = _layer_path(out_dir, table)
        # The declared layer schema is enforced at the sink (df.to: reorder, cast, reject extras).
        write_table(df, path, "WRITE_TRUNCATE", partition_by=part, cluster_by=cluster,
                    schema=LAYER_SCHEMAS[step])
        return counted(step)

    def counted(step: str) -> DataFrame:
        table, path = LAYERS[step][0], _layer_path(out_dir, LAYERS[step][0])
        back = spark.read.parquet(path)
        # Counted on the written layer: Parquet answers from file footers. (DataFrame.observe is
        # avoided: in Spark 4.1 a session that has used it can no longer serialize MLlib
        # forest models captured in later transform closures.)
        n = back.count()
        report.append((step, table, path, n, min_rows, n >= min_rows, run_id))
        if n < min_rows:
            raise ValueError(f"{table}: {n} rows < minimum {min_rows}")
        return back

    staged = land("staging", stage_inventory(raw, as_of, run_ts, run_id, tie_keys=tie_keys))
    for batch in [po] if isinstance(po, DataFrame) else po:
        upsert_purchase_orders(spark, batch, _layer_path(out_dir, LAYERS["purchase_orders"][0]))
    orders = counted("purchase_orders")
    signals = land("demand_signals", demand_signals(staged, as_of, run_ts, run_id))
    features = land("sku_risk_features", sku_risk_features(signals, staged, orders, as_of, run_ts, run_id))
    land("delay_risk_scores", delay_risk_scores(features, run_ts))
    return spark.createDataFrame(report, "step string, table string, path string, row_count bigint, "
                                         "min_rows bigint, passed boolean, pipeline_run_id string")


def register_layer_views(spark: SparkSession, out_dir: str) -> list[str]:
    """Medallion views over the written layers (no copy): staging_*, analytics_*, ml_features_*."""
    names = []
    for table, _, _ in LAYERS.values():
        name = table.replace(".", "_")
        spark.read.parquet(_layer_path(out_dir, table)).createOrReplaceTempView(name)
        names.append(name)
    return names


def run_sql(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Templated SQL with named parameter markers (``:name``), never string substitution."""
    return spark.sql(sql, args=args or {})
