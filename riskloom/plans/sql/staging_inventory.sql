-- Typed, filtered, deduplicated inventory transactions.
-- tables: :raw; values: :as_of, :run_ts, :run_id
SELECT transaction_id, sku_id, vendor_id, warehouse_id, quantity, transaction_type, unit_cost, transaction_timestamp,
  transaction_date, signed_quantity, source_system, source_file, CAST(:as_of AS DATE) AS ingestion_date,
  CAST(:run_ts AS TIMESTAMP_NTZ) AS processed_at, :run_id AS pipeline_run_id, 'v1.0' AS schema_version
FROM (
  SELECT CAST(transaction_id AS STRING) AS transaction_id, CAST(sku_id AS STRING) AS sku_id,
    CAST(vendor_id AS STRING) AS vendor_id, CAST(warehouse_id AS STRING) AS warehouse_id, units AS quantity,
    kind AS transaction_type, TRY_CAST(unit_cost AS DOUBLE) AS unit_cost, moment AS transaction_timestamp,
    CAST(moment AS DATE) AS transaction_date,
    CASE WHEN kind IN ('receipt', 'adjustment_in', 'transfer_in') THEN abs(units)
         WHEN kind IN ('shipment', 'adjustment_out', 'transfer_out', 'consumption') THEN -abs(units)
         ELSE units END AS signed_quantity,
    CAST(source_system AS STRING) AS source_system, CAST(source_file AS STRING) AS source_file,
    row_number() OVER (PARTITION BY transaction_id ORDER BY moment DESC, tie_key DESC) AS version
  FROM (
    SELECT *, TRY_CAST(round(TRY_CAST(quantity AS DOUBLE), 0) AS BIGINT) AS units,
      lower(trim(CAST(transaction_type AS STRING))) AS kind, TRY_CAST(transaction_timestamp AS TIMESTAMP_NTZ) AS moment
    FROM IDENTIFIER(:raw))
  WHERE transaction_id IS NOT NULL AND sku_id IS NOT NULL AND moment IS NOT NULL AND units <> 0)
WHERE version = 1
