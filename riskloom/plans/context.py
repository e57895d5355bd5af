"""Inputs of the registered queries, built from the driver tables.

``Inputs`` is a thin lazy holder: each property is a DataFrame plan, not
data. Nothing is collected; Spark re-plans each query from the parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

import datetime as dt

from riskloom.operators.clock import expand_snapshots
from riskloom.operators.demand import daily_demand_all, demand_signals, signals_from_daily
from riskloom.operators.features import features_from_parts, sku_risk_features
from riskloom.operators.leadtime import daily_lead_counts, daily_vendor_counts, sku_vendor_map, vendor_lead_times
from riskloom.operators.staging import Dedup, dedup_latest, dedup_sized, stage_inventory
from riskloom.plans.pipeline import upsert_purchase_orders
from riskloom.plans.stored import stored
from riskloom.session import apply_settings, ensure_checkpoint_dir
from riskloom.sources import fixtures as fx
from riskloom.streaming.runner import materialize


# Days between training snapshots (the last one is on the as-of date); days that demand signals look back.
TRAIN_STEP = 30
WARM_UP_DAYS = 120


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, sku_mod: int | None = fx.SKU_MOD):
        apply_settings(spark)
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.sku_mod = sku_mod
        self.as_of = fx.AS_OF
        self.run_ts = fx.RUN_TS
        self.run_id = fx.RUN_ID

    def table(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return fx.raw_inventory_transactions(self.table("lineitem"), self.sku_mod)

    @cached_property
    def raw_po(self) -> DataFrame:
        return fx.purchase_order_receipts(self.table("lineitem"), self.table("orders"), self.sku_mod)

    @cached_property
    def raw_po_table(self) -> DataFrame:
        """``raw_po`` as a stored table: joined once; every batch, and the count that sizes its dedup, reads its rows."""
        return materialize(fx.sized_purchase_order_receipts(self.table("lineitem"), self.table("orders"), self.sku_mod),
                           "purchase-orders-raw")

    @cached_property
    def po(self) -> DataFrame:
        """The purchase-order layer: a first batch, then one with late receipts merged in; stored once a session."""
        def build(path: str) -> None:
            for batch in fx.po_batches(self.raw_po_table, self.as_of):
                upsert_purchase_orders(self.spark, batch, path)
        sources = [f"{self.sf_dir}/{t}.parquet" for t in ("lineitem", "orders")]
        return stored(self.spark, f"purchase-orders-{self.sku_mod}", sources, build)

    @cached_property
    def staged(self) -> DataFrame:
        return stage_inventory(self.raw, self.as_of, self.run_ts, self.run_id, tie_keys=("tie_key",))

    @cached_property
    def recent_staged(self) -> DataFrame:
        """Staged rows of the warm-up range.

        Staging keeps the latest row of an id, so a lower bound on the
        timestamp may go below the dedup (and into the scan): it never drops
        the row that stays unless all rows of that id are older. An upper
        bound may not.
        """
        return self._recent(dedup_latest)

    def _recent(self, dedup: Dedup) -> DataFrame:
        since = dt.datetime.combine(self.as_of - dt.timedelta(days=WARM_UP_DAYS), dt.time())
        raw = self.raw.where(F.col("transaction_timestamp") >= F.lit(since).cast("timestamp_ntz"))
        return stage_inventory(raw, self.as_of, self.run_ts, self.run_id, tie_keys=("tie_key",), dedup=dedup)

    @cached_property
    def recent_table(self) -> DataFrame:
        """``recent_staged`` as a stored table, for plans that read it in two branches."""
        return materialize(self._recent(dedup_sized), "staged-recent")

    @cached_property
    def signals(self) -> DataFrame:
        return demand_signals(self.recent_staged, self.as_of, self.run_ts, self.run_id)

    @cached_property
    def features(self) -> DataFrame:
        signals = demand_signals(self.recent_table, self.as_of, self.run_ts, self.run_id)
        return sku_risk_features(signals, self.recent_table, self.po, self.as_of, self.run_ts, self.run_id)

    # ---- training fixture (FIXTURES.md): inbound receipts x6, snapshots every 30 days back to the first transaction.
    # The SKU mapping is the same as everywhere else, so the oracle SQL agrees at every scale.
    @cached_property
    def training_sku_mod(self) -> int | None:
        return self.sku_mod

    @cached_property
    def training_po(self) -> DataFrame:
        return self.po

    @cached_property
    def training_staged(self) -> DataFrame:
        raw = fx.raw_inventory_transactions(self.table("lineitem"), self.training_sku_mod)
        t = F.lower(F.trim(F.col("transaction_type")))
        raw = raw.withColumn("quantity", F.when(t.isin("receipt", "adjustment_in"), F.col("quantity") * 6)
                             .otherwise(F.col("quantity")))
        return stage_inventory(raw, self.as_of, self.run_ts, self.run_id, tie_keys=("tie_key",), dedup=dedup_sized)

    @cached_property
    def training_grid(self) -> tuple[dt.date, int, int]:
        """(first snapshot, step, count): from the as-of date back to the first transaction of the data."""
        first = self.raw.agg(F.min(F.to_date("transaction_timestamp"))).first()[0] or self.as_of
        count = max(1, (self.as_of - first).days // TRAIN_STEP + 1)
        return self.as_of - dt.timedelta(days=TRAIN_STEP * (count - 1)), TRAIN_STEP, count

    @cached_property
    def training_features(self) -> DataFrame:
        """Feature rows for all training snapshots, computed in one job."""
        start, step, count = self.training_grid
        # Aggregate to days first (independent of the snapshot), then copy days to snapshots.
        # Staged once for both aggregates, with the columns they read.
        staged = materialize(self.training_staged.select("sku_id", "vendor_id", "transaction_type", "signed_quantity",
                                                         "transaction_date"), "training-staged")
        daily = expand_snapshots(daily_demand_all(staged), "transaction_date",
                                 start, step, count, 120)
        vendors = expand_snapshots(daily_vendor_counts(staged), "transaction_date",
                                   start, step, count, 90)
        po = expand_snapshots(daily_lead_counts(self.training_po), "po_date", start, step, count, 90)
        signals = signals_from_daily(daily, None, self.run_ts, self.run_id)
        return features_from_parts(signals, sku_vendor_map(vendors, None), vendor_lead_times(po, None),
                                   None, self.run_ts, self.run_id)

    # ---- the feature tables as stored tables: consumers that read features more than
    # once (latest-snapshot subquery + rows, as-of dates + rows, scalar counts) read this
    # lineage cut instead of re-running the feature chain in every branch of their plan.
    @cached_property
    def features_table(self) -> DataFrame:
        return materialize(self.features, "features")

    @cached_property
    def training_table(self) -> DataFrame:
        """All training snapshots, stored once a session for the queries that start from them."""
        sources = [f"{self.sf_dir}/{t}.parquet" for t in ("lineitem", "orders")]
        return stored(self.spark, f"training-features-{self.sku_mod}", sources,
                      lambda path: self.training_features.write.parquet(path))

    @cached_property
    def messages(self) -> DataFrame:
        return fx.event_messages(self.table("events"))


def rounded(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round floating columns for cross-engine comparison (last-bit noise)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in keep:
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
