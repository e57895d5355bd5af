-- Scores and bands of the newest feature snapshot.
-- tables: :features; values: :run_ts, :high, :medium
SELECT sku_id, vendor_id, delay_risk_score AS risk_score,
  CASE WHEN delay_risk_score >= :high THEN 'HIGH' WHEN delay_risk_score >= :medium THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  supply_risk_flag, days_of_supply, lead_time_p90, feature_date AS score_date, CAST(:run_ts AS TIMESTAMP_NTZ) AS scored_at
FROM IDENTIFIER(:features) WHERE feature_date = (SELECT max(feature_date) FROM IDENTIFIER(:features))
