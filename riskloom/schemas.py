"""Declared table schemas (one StructType per table, used by sinks and tests).

Batch and stream rows of the same table share one schema; columns a source
does not carry arrive as NULL. Timestamps are wall-clock (TIMESTAMP_NTZ).
"""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructType

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "boolean": T.BooleanType()}


def _schema(columns: str) -> StructType:
    """'name type, name type, ...' with simple types -> StructType (usable before any session)."""
    return StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


RAW_INVENTORY = _schema(
    "transaction_id string, sku_id string, vendor_id string, warehouse_id string, quantity bigint, "
    "transaction_type string, unit_cost double, transaction_timestamp timestamp_ntz, source_system string, "
    "source_file string")
STAGED_INVENTORY = _schema(
    "transaction_id string, sku_id string, vendor_id string, warehouse_id string, quantity bigint, "
    "transaction_type string, unit_cost double, transaction_timestamp timestamp_ntz, transaction_date date, "
    "signed_quantity bigint, source_system string, source_file string, ingestion_date date, "
    "processed_at timestamp_ntz, pipeline_run_id string, schema_version string")
PO_RECEIPTS = _schema(
    "po_id string, vendor_id string, sku_id string, po_date date, expected_date date, receipt_date date, "
    "receipt_timestamp timestamp_ntz, lead_days bigint, receipt_before_po boolean, order_key bigint")
DEMAND_SIGNALS = _schema(
    "sku_id string, signal_date date, demand_7d bigint, demand_30d bigint, demand_90d bigint, "
    "demand_cv_30d double, stockout_days_30d bigint, stockout_flag int, days_of_supply double, "
    "active_days_90d bigint, last_transaction_date date, days_since_last_activity bigint, "
    "demand_acceleration_ratio double, computed_at timestamp_ntz, pipeline_run_id string")
SKU_RISK_FEATURES = _schema(
    "sku_id string, vendor_id string, feature_date date, demand_7d bigint, demand_30d bigint, "
    "demand_90d bigint, demand_cv_30d double, demand_acceleration_ratio double, days_of_supply double, "
    "stockout_flag int, stockout_days_30d bigint, days_since_last_activity bigint, lead_time_p50 bigint, "
    "lead_time_p90 bigint, late_delivery_rate double, po_count_90d bigint, demand_pressure_ratio double, "
    "supply_risk_flag int, delay_risk_score double, computed_at timestamp_ntz, pipeline_run_id string, "
    "feature_schema_version string")
DELAY_RISK_SCORES = _schema(
    "sku_id string, vendor_id string, risk_score double, risk_level string, supply_risk_flag int, "
    "days_of_supply double, lead_time_p90 bigint, score_date date, scored_at timestamp_ntz")
EVENT_ENVELOPE = _schema(
    "message_id string, topic string, event_type string, payload string, publish_time timestamp_ntz, "
    "delivery_attempt int, payload_is_json boolean")
INGESTED_EVENTS = _schema(
    "message_id string, topic string, transaction_id string, sku_id string, vendor_id string, quantity bigint, "
    "transaction_type string, transaction_timestamp timestamp_ntz, reject_reasons string, is_valid boolean, "
    "source_system string, ingestion_date date, pipeline_run_id string, _ingested_at timestamp_ntz")
FILE_MANIFEST = _schema(
    "path string, zone string, source_system string, landing_date date, ingestion_timestamp timestamp_ntz, "
    "schema_version string, record_count bigint, pipeline_run_id string, original_filename string, "
    "content_type string")
EVENTS_SOURCE = _schema(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")

PO_LAYER = StructType([*PO_RECEIPTS.fields, T.StructField("po_month", T.DateType())])

LAYER_SCHEMAS = {
    "purchase_orders": PO_LAYER,
    "staging": STAGED_INVENTORY,
    "demand_signals": DEMAND_SIGNALS,
    "sku_risk_features": SKU_RISK_FEATURES,
    "delay_risk_scores": DELAY_RISK_SCORES,
}


def same_columns(a: StructType, b: StructType) -> bool:
    """Names and types equal in order (nullability ignored)."""
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]
