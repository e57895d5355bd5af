-- One feature row per SKU: signals, the main vendor's lead times, the risk flag and score.
-- tables: :signals, :staging, :orders; values: :as_of, :run_ts, :run_id, :days,
--   :default_p50, :default_p90, :flag_acceleration, :flag_late, :w_late, :w_stockout, :w_coverage, :w_variability
WITH vendors AS (
  SELECT sku_id, vendor_id FROM (
    SELECT sku_id, vendor_id, row_number() OVER (PARTITION BY sku_id ORDER BY count(*) DESC, vendor_id) AS place
    FROM IDENTIFIER(:staging)
    WHERE transaction_date BETWEEN date_sub(CAST(:as_of AS DATE), :days) AND CAST(:as_of AS DATE) AND vendor_id IS NOT NULL
    GROUP BY sku_id, vendor_id)
  WHERE place = 1),
leads AS (
  SELECT vendor_id, sku_id, datediff(receipt_date, po_date) AS lead,
    CASE WHEN receipt_date > expected_date THEN 1.0D ELSE 0.0D END AS late
  FROM IDENTIFIER(:orders) WHERE po_date BETWEEN date_sub(CAST(:as_of AS DATE), :days) AND CAST(:as_of AS DATE)),
lead_times AS (
  SELECT vendor_id, sku_id, percentile_disc(0.5) WITHIN GROUP (ORDER BY lead) AS p50,
    percentile_disc(0.9) WITHIN GROUP (ORDER BY lead) AS p90, avg(late) AS late, count(*) AS n
  FROM leads GROUP BY vendor_id, sku_id),
joined AS (
  SELECT s.*, v.vendor_id, CAST(coalesce(l.p50, :default_p50) AS BIGINT) AS p50, CAST(coalesce(l.p90, :default_p90) AS BIGINT) AS p90,
    coalesce(l.late, 0.0D) AS late, coalesce(l.n, 0L) AS n_orders
  FROM IDENTIFIER(:signals) s
  LEFT JOIN vendors v ON s.sku_id = v.sku_id
  LEFT JOIN lead_times l ON s.sku_id = l.sku_id AND v.vendor_id = l.vendor_id
  WHERE s.signal_date = CAST(:as_of AS DATE)),
scored AS (
  SELECT *, :w_late * late + :w_stockout * (stockout_days_30d / 30.0D)
      + :w_coverage * (1.0D - least(days_of_supply / 30.0D, 1.0D)) + :w_variability * least(demand_cv_30d, 1.0D) AS score
  FROM joined)
SELECT sku_id, vendor_id, CAST(:as_of AS DATE) AS feature_date, demand_7d, demand_30d, demand_90d, demand_cv_30d,
  demand_acceleration_ratio, days_of_supply, stockout_flag, stockout_days_30d, days_since_last_activity,
  p50 AS lead_time_p50, p90 AS lead_time_p90, late AS late_delivery_rate, n_orders AS po_count_90d,
  try_divide(demand_30d, nullif(days_of_supply, 0)) AS demand_pressure_ratio,
  CASE WHEN stockout_flag = 1 AND demand_acceleration_ratio > :flag_acceleration THEN 1
       WHEN late > :flag_late THEN 1 WHEN days_of_supply < p90 THEN 1 ELSE 0 END AS supply_risk_flag,
  least(1.0D, greatest(0.0D, score)) AS delay_risk_score, CAST(:run_ts AS TIMESTAMP_NTZ) AS computed_at,
  :run_id AS pipeline_run_id, 'v1.0' AS feature_schema_version
FROM scored
