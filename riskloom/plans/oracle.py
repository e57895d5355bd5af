"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written from the table semantics, not from the DataFrame code. Each query
starts with the fixture CTEs of FIXTURES.md §2 over the driver's views.
Doubles are ROUND(x, 6); integer sums are cast to BIGINT (DuckDB sums are
HUGEINT); timestamps stay wall-clock.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"
RUN_TS = "TIMESTAMP '2001-08-01 06:00:00'"
RUN_ID = "'pipeline-20010801-060000'"


def fixture_ctes(sku_mod: int = 50) -> str:
    return f"""
raw_inventory_transactions AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'SKU-' || CAST(l_partkey % {sku_mod} AS VARCHAR) END AS sku_id,
    CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE 'V-' || CAST(l_suppkey % 10 AS VARCHAR) END AS vendor_id,
    'WH-' || CAST(l_linenumber % 3 AS VARCHAR) AS warehouse_id,
    CASE WHEN l_quantity = 50 THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS quantity,
    CASE WHEN l_linenumber = 7 THEN 'cycle_count'
         WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN ' Receipt '
         WHEN l_returnflag = 'R' THEN 'ADJUSTMENT_IN'
         WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'shipment'
         WHEN l_returnflag = 'A' THEN 'Consumption'
         WHEN l_linestatus = 'O' THEN 'transfer_out'
         ELSE 'adjustment_out' END AS transaction_type,
    l_extendedprice / l_quantity AS unit_cost,
    l_shipdate AS transaction_timestamp,
    'sage100' AS source_system, 'lineitem.parquet' AS source_file,
    l_extendedprice AS tie_key
  FROM lineitem
),
raw_po AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS po_id,
    'V-' || CAST(l_suppkey % 10 AS VARCHAR) AS vendor_id,
    'SKU-' || CAST(l_partkey % {sku_mod} AS VARCHAR) AS sku_id,
    CAST(o_orderdate AS DATE) AS po_date,
    CAST(o_orderdate AS DATE) + CAST(35 + l_suppkey % 15 AS INT) AS expected_date,
    CASE WHEN (l_orderkey + l_linenumber) % 23 <> 0
         THEN CAST(o_orderdate AS DATE) + CAST(1 + (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 45 AS INT) END AS receipt_date,
    l_orderkey AS order_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
purchase_order_receipts AS (
  SELECT * FROM raw_po WHERE po_id IS NOT NULL AND po_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY po_id ORDER BY receipt_date DESC NULLS LAST, vendor_id, sku_id, expected_date) = 1
),
event_messages AS (
  SELECT message_id, topic, attr_event_type, delivery_attempt, publish_time,
    CASE WHEN src = 'error' AND event_id % 2 = 0 THEN '{{"id": '
         WHEN src = 'error' THEN '{{"sku_id":"SKU-' || CAST(user_id % 50 AS VARCHAR) || '"}}'
         ELSE '{{"transaction_id":"T-' || CAST(event_id AS VARCHAR) || '","sku_id":"SKU-' || CAST(user_id % 50 AS VARCHAR)
           || '","quantity":' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ',"event_type":"' || etype || '"}}' END AS data,
    event_id, user_id, value, src
  FROM (SELECT event_id, user_id, value, src, etype, 'M-' || CAST(event_id AS VARCHAR) AS message_id, topic,
      CASE WHEN src = 'error' AND event_id % 4 = 0 THEN 'pick' WHEN src = 'error' OR event_id % 5 = 0 THEN NULL ELSE etype END AS attr_event_type,
      CAST(event_id % 7 AS INT) AS delivery_attempt, ts AS publish_time
    FROM (SELECT *, event_type AS src,
        CASE user_id % 3 WHEN 0 THEN 'erp-transactions' WHEN 1 THEN 'inventory-events' ELSE 'order-events' END AS topic,
        CASE WHEN user_id % 3 = 0 THEN CASE event_type WHEN 'purchase' THEN 'po_created' WHEN 'view' THEN 'po_received' WHEN 'click' THEN 'invoice_posted' ELSE 'price_changed' END
             WHEN user_id % 3 = 1 THEN CASE event_type WHEN 'purchase' THEN 'pick' WHEN 'view' THEN 'putaway' WHEN 'click' THEN 'cycle_count' ELSE 'adjustment' END
             ELSE CASE event_type WHEN 'purchase' THEN 'order_placed' WHEN 'view' THEN 'order_shipped' WHEN 'click' THEN 'order_delayed' ELSE 'order_cancelled' END END AS etype
      FROM events) a) b
),
staged AS ({_staged_sql("raw_inventory_transactions")}),
daily AS (
  SELECT sku_id, transaction_date,
    CAST(SUM(CASE WHEN transaction_type IN ('shipment', 'consumption', 'transfer_out') THEN abs(signed_quantity) ELSE 0 END) AS BIGINT) AS daily_demand_units,
    CAST(SUM(CASE WHEN transaction_type IN ('receipt', 'adjustment_in', 'transfer_in') THEN abs(signed_quantity) ELSE 0 END) AS BIGINT) AS daily_receipt_units,
    COUNT(DISTINCT transaction_id) AS daily_transaction_count
  FROM staged
  WHERE transaction_date BETWEEN {AS_OF} - 120 AND {AS_OF}
  GROUP BY sku_id, transaction_date
),
running AS (
  SELECT *, CAST(SUM(daily_receipt_units - daily_demand_units) OVER (
      PARTITION BY sku_id ORDER BY transaction_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS running_inventory_balance
  FROM daily
),
signals_agg AS (
  SELECT sku_id,
    SUM(CASE WHEN transaction_date >= {AS_OF} - 7 THEN daily_demand_units ELSE 0 END) AS d7w,
    SUM(daily_demand_units) AS d90,
    SUM(CASE WHEN transaction_date >= {AS_OF} - 30 THEN daily_demand_units ELSE 0 END) AS d30,
    stddev_samp(CASE WHEN transaction_date >= {AS_OF} - 30 THEN daily_demand_units END)
      / NULLIF(avg(CASE WHEN transaction_date >= {AS_OF} - 30 THEN daily_demand_units END), 0) AS cv,
    count_if(running_inventory_balance <= 0 AND transaction_date >= {AS_OF} - 30) AS so30,
    MAX(CASE WHEN running_inventory_balance <= 0 THEN 1 ELSE 0 END) AS so_flag,
    MAX(running_inventory_balance) / NULLIF(avg(CASE WHEN transaction_date >= {AS_OF} - 7 THEN daily_demand_units END), 0) AS dos,
    COUNT(DISTINCT transaction_date) AS active_days,
    MAX(transaction_date) AS last_date
  FROM running
  WHERE transaction_date BETWEEN {AS_OF} - 90 AND {AS_OF}
  GROUP BY sku_id
),
signals_w AS ({_signals_select('d7w')}),
signals_aw AS ({_signals_select('d90')}),
lead_rows AS (
  SELECT vendor_id, sku_id, date_diff('day', po_date, receipt_date) AS lead_days,
    CASE WHEN date_diff('day', expected_date, receipt_date) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_late
  FROM purchase_order_receipts
  WHERE po_date BETWEEN {AS_OF} - 90 AND {AS_OF}
),
vlt AS (
  SELECT vendor_id, sku_id,
    CAST(quantile_disc(lead_days, 0.5) AS BIGINT) AS lead_time_p50,
    CAST(quantile_disc(lead_days, 0.9) AS BIGINT) AS lead_time_p90,
    avg(is_late) AS late_delivery_rate,
    COUNT(*) AS po_count_90d
  FROM lead_rows GROUP BY vendor_id, sku_id
),
svm AS (
  SELECT sku_id, vendor_id, transaction_count FROM (
    SELECT sku_id, vendor_id, COUNT(*) AS transaction_count
    FROM staged
    WHERE transaction_date BETWEEN {AS_OF} - 90 AND {AS_OF} AND vendor_id IS NOT NULL
    GROUP BY sku_id, vendor_id) c
  QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY transaction_count DESC, vendor_id ASC) = 1
),
features AS (
  SELECT d.sku_id, m.vendor_id, {AS_OF} AS feature_date,
    d.demand_7d, d.demand_30d, d.demand_90d, d.demand_cv_30d, d.demand_acceleration_ratio,
    d.days_of_supply, d.stockout_flag, d.stockout_days_30d, d.days_since_last_activity,
    COALESCE(v.lead_time_p50, 14) AS lead_time_p50,
    COALESCE(v.lead_time_p90, 21) AS lead_time_p90,
    COALESCE(v.late_delivery_rate, 0.0::DOUBLE) AS late_delivery_rate,
    COALESCE(v.po_count_90d, 0) AS po_count_90d,
    d.demand_30d / NULLIF(d.days_of_supply, 0) AS demand_pressure_ratio,
    CASE WHEN d.stockout_flag = 1 AND d.demand_acceleration_ratio > 1.2 THEN 1
         WHEN COALESCE(v.late_delivery_rate, 0) > 0.25 THEN 1
         WHEN d.days_of_supply < COALESCE(v.lead_time_p90, 21) THEN 1
         ELSE 0 END AS supply_risk_flag,
    CASE WHEN d.stockout_flag = 1 AND d.demand_acceleration_ratio > 1.2 THEN 1
         WHEN COALESCE(v.late_delivery_rate, 0) > 0.25 THEN 2
         WHEN d.days_of_supply < COALESCE(v.lead_time_p90, 21) THEN 3
         ELSE 0 END AS flag_branch,
    least(1.0::DOUBLE, greatest(0.0::DOUBLE,
        0.3 * COALESCE(v.late_delivery_rate, 0.0::DOUBLE)
      + 0.3 * (d.stockout_days_30d / 30.0::DOUBLE)
      + 0.2 * (1.0::DOUBLE - least(d.days_of_supply / 30.0::DOUBLE, 1.0::DOUBLE))
      + 0.2 * least(d.demand_cv_30d, 1.0::DOUBLE))) AS delay_risk_score,
    {RUN_TS} AS computed_at, {RUN_ID} AS pipeline_run_id, 'v1.0' AS feature_schema_version
  FROM signals_w d
  LEFT JOIN svm m ON d.sku_id = m.sku_id
  LEFT JOIN vlt v ON d.sku_id = v.sku_id AND m.vendor_id = v.vendor_id
)"""


def _staged_sql(src: str) -> str:
    return f"""
  SELECT transaction_id, sku_id, vendor_id, warehouse_id, quantity, transaction_type, unit_cost,
    transaction_timestamp, transaction_date, signed_quantity, source_system, source_file,
    {AS_OF} AS ingestion_date, {RUN_TS} AS processed_at, {RUN_ID} AS pipeline_run_id,
    'v1.0' AS schema_version
  FROM (
    SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(sku_id AS VARCHAR) AS sku_id,
      CAST(vendor_id AS VARCHAR) AS vendor_id, CAST(warehouse_id AS VARCHAR) AS warehouse_id,
      CAST(ROUND(quantity) AS BIGINT) AS quantity, lower(trim(transaction_type)) AS transaction_type,
      CAST(unit_cost AS DOUBLE) AS unit_cost, transaction_timestamp,
      CAST(transaction_timestamp AS DATE) AS transaction_date,
      CASE WHEN lower(trim(transaction_type)) IN ('receipt', 'adjustment_in', 'transfer_in') THEN abs(quantity)
           WHEN lower(trim(transaction_type)) IN ('shipment', 'adjustment_out', 'transfer_out', 'consumption') THEN -abs(quantity)
           ELSE quantity END AS signed_quantity,
      source_system, source_file, tie_key
    FROM {src}
    WHERE transaction_id IS NOT NULL AND sku_id IS NOT NULL AND transaction_timestamp IS NOT NULL
      AND quantity IS NOT NULL AND quantity <> 0
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_timestamp DESC, tie_key DESC) = 1
  ) s
"""


def _signals_select(d7: str) -> str:
    return f"""SELECT sku_id, {AS_OF} AS signal_date,
    CAST({d7} AS BIGINT) AS demand_7d, CAST(d30 AS BIGINT) AS demand_30d, CAST(d90 AS BIGINT) AS demand_90d,
    COALESCE(cv, 0.0::DOUBLE) AS demand_cv_30d,
    CAST(so30 AS BIGINT) AS stockout_days_30d, CAST(so_flag AS INTEGER) AS stockout_flag,
    COALESCE(CAST(dos AS DOUBLE), 0.0::DOUBLE) AS days_of_supply,
    CAST(active_days AS BIGINT) AS active_days_90d, last_date AS last_transaction_date,
    CAST(date_diff('day', last_date, {AS_OF}) AS BIGINT) AS days_since_last_activity,
    CAST({d7} AS DOUBLE) / NULLIF(CAST(d30 - {d7} AS DOUBLE), 0) AS demand_acceleration_ratio,
    {RUN_TS} AS computed_at, {RUN_ID} AS pipeline_run_id
  FROM signals_agg WHERE d90 > 0 OR active_days > 0"""


def with_fixtures(body: str, sku_mod: int = 50) -> str:
    return f"WITH {fixture_ctes(sku_mod)}\n{body}"


def r6(expr: str, name: str) -> str:
    return f"ROUND({expr}, 6) AS {name}"


ORACLES: dict[str, str] = {}


def oracle(key: str, body: str) -> None:
    ORACLES[key] = with_fixtures(body)


oracle("stage_inventory", f"""
SELECT transaction_id, sku_id, vendor_id, warehouse_id, quantity, transaction_type,
  unit_cost, transaction_timestamp, transaction_date, signed_quantity,
  source_system, source_file, ingestion_date, processed_at, pipeline_run_id, schema_version
FROM staged""")

oracle("dedup_latest", """
SELECT transaction_id, sku_id, quantity, transaction_timestamp, tie_key
FROM raw_inventory_transactions WHERE transaction_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_timestamp DESC, tie_key DESC) = 1""")

oracle("signed_quantity", """
SELECT lower(trim(transaction_type)) AS transaction_type, COUNT(*) AS n_rows,
  CAST(SUM(CASE WHEN lower(trim(transaction_type)) IN ('receipt', 'adjustment_in', 'transfer_in') THEN abs(quantity)
                WHEN lower(trim(transaction_type)) IN ('shipment', 'adjustment_out', 'transfer_out', 'consumption') THEN -abs(quantity)
                ELSE quantity END) AS BIGINT) AS sum_signed_quantity
FROM raw_inventory_transactions GROUP BY 1""")

oracle("stage_po_receipts", """
SELECT po_id, vendor_id, sku_id, po_date, expected_date, receipt_date,
  CAST(receipt_date AS TIMESTAMP) AS receipt_timestamp,
  date_diff('day', po_date, receipt_date) AS lead_days,
  receipt_date < po_date AS receipt_before_po, order_key
FROM raw_po WHERE po_id IS NOT NULL AND po_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY po_id ORDER BY receipt_date DESC NULLS LAST,
  vendor_id ASC, sku_id ASC, expected_date ASC) = 1""")

oracle("daily_demand", "SELECT * FROM daily")
oracle("running_inventory", "SELECT * FROM running")


def _signals_out(src: str) -> str:
    return f"""
SELECT sku_id, signal_date, demand_7d, demand_30d, demand_90d, {r6('demand_cv_30d', 'demand_cv_30d')},
  stockout_days_30d, stockout_flag, {r6('days_of_supply', 'days_of_supply')}, active_days_90d,
  last_transaction_date, days_since_last_activity,
  {r6('demand_acceleration_ratio', 'demand_acceleration_ratio')}, computed_at, pipeline_run_id
FROM {src}"""


oracle("demand_signals", _signals_out("signals_w"))
oracle("demand_signals_as_written", _signals_out("signals_aw"))

oracle("vendor_lead_times", f"""
SELECT vendor_id, sku_id, lead_time_p50, lead_time_p90, {r6('late_delivery_rate', 'late_delivery_rate')},
  po_count_90d FROM vlt""")

ORACLES["vendor_lead_times_sketch"] = ORACLES["vendor_lead_times"]

oracle("sku_vendor_map", "SELECT sku_id, vendor_id, transaction_count FROM svm")

FEATURE_COLS = f"""sku_id, vendor_id, feature_date, demand_7d, demand_30d, demand_90d,
  {r6('demand_cv_30d', 'demand_cv_30d')}, {r6('demand_acceleration_ratio', 'demand_acceleration_ratio')},
  {r6('days_of_supply', 'days_of_supply')}, stockout_flag, stockout_days_30d, days_since_last_activity,
  lead_time_p50, lead_time_p90, {r6('late_delivery_rate', 'late_delivery_rate')}, po_count_90d,
  {r6('demand_pressure_ratio', 'demand_pressure_ratio')}, supply_risk_flag,
  {r6('delay_risk_score', 'delay_risk_score')}, computed_at, pipeline_run_id, feature_schema_version"""

oracle("sku_risk_features", f"SELECT {FEATURE_COLS} FROM features")
oracle("supply_risk_flag", "SELECT sku_id, supply_risk_flag, flag_branch FROM features")
oracle("risk_score", f"""
SELECT sku_id, {r6('late_delivery_rate', 'late_delivery_rate')}, stockout_days_30d,
  {r6('days_of_supply', 'days_of_supply')}, {r6('demand_cv_30d', 'demand_cv_30d')},
  {r6('delay_risk_score', 'delay_risk_score')} FROM features""")

oracle("delay_risk_scores", f"""
SELECT sku_id, vendor_id, {r6('delay_risk_score', 'risk_score')},
  CASE WHEN delay_risk_score >= 0.7 THEN 'HIGH' WHEN delay_risk_score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  supply_risk_flag, {r6('days_of_supply', 'days_of_supply')}, lead_time_p90,
  feature_date AS score_date, {RUN_TS} AS scored_at
FROM features WHERE feature_date = (SELECT MAX(feature_date) FROM features)""")

oracle("latest_snapshot", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date
FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)""")


def training_ctes() -> str:
    """Training fixture in SQL: receipts x6, snapshots every 30 days back to the first transaction, joined by date range."""
    dem = "transaction_type IN ('shipment', 'consumption', 'transfer_out')"
    rec = "transaction_type IN ('receipt', 'adjustment_in', 'transfer_in')"
    return f""",
snaps AS (SELECT CAST({AS_OF} - CAST(30 * k AS INTEGER) AS DATE) AS as_of FROM (
  SELECT unnest(range(0, n)) AS k FROM (
    SELECT CAST(floor(date_diff('day', CAST(MIN(transaction_timestamp) AS DATE), {AS_OF}) / 30) AS BIGINT) + 1 AS n
    FROM raw_inventory_transactions) c) t),
traw AS (SELECT * REPLACE (CASE WHEN transaction_type IN (' Receipt ', 'ADJUSTMENT_IN') THEN quantity * 6
                                ELSE quantity END AS quantity) FROM raw_inventory_transactions),
tstaged AS ({_staged_sql("traw")}),
mdaily AS (
  SELECT s.as_of, t.sku_id, t.transaction_date,
    CAST(SUM(CASE WHEN {dem} THEN abs(signed_quantity) ELSE 0 END) AS BIGINT) AS dem,
    CAST(SUM(CASE WHEN {rec} THEN abs(signed_quantity) ELSE 0 END) AS BIGINT) AS rec
  FROM tstaged t JOIN snaps s ON t.transaction_date BETWEEN s.as_of - 120 AND s.as_of
  GROUP BY s.as_of, t.sku_id, t.transaction_date),
mrun AS (SELECT *, SUM(rec - dem) OVER (PARTITION BY as_of, sku_id ORDER BY transaction_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bal FROM mdaily),
magg AS (
  SELECT as_of, sku_id,
    SUM(CASE WHEN transaction_date >= as_of - 7 THEN dem ELSE 0 END) AS d7,
    SUM(CASE WHEN transaction_date >= as_of - 30 THEN dem ELSE 0 END) AS d30,
    SUM(dem) AS d90,
    stddev_samp(CASE WHEN transaction_date >= as_of - 30 THEN dem END)
      / NULLIF(avg(CASE WHEN transaction_date >= as_of - 30 THEN dem END), 0) AS cv,
    count_if(bal <= 0 AND transaction_date >= as_of - 30) AS so30,
    MAX(CASE WHEN bal <= 0 THEN 1 ELSE 0 END) AS so_flag,
    MAX(bal) / NULLIF(avg(CASE WHEN transaction_date >= as_of - 7 THEN dem END), 0) AS dos,
    COUNT(*) AS active_days, MAX(transaction_date) AS last_date
  FROM mrun WHERE transaction_date BETWEEN as_of - 90 AND as_of GROUP BY as_of, sku_id),
msig AS (
  SELECT sku_id, as_of AS signal_date, CAST(d7 AS BIGINT) AS demand_7d, CAST(d30 AS BIGINT) AS demand_30d,
    CAST(d90 AS BIGINT) AS demand_90d, COALESCE(cv, 0.0::DOUBLE) AS demand_cv_30d,
    CAST(so30 AS BIGINT) AS stockout_days_30d, so_flag AS stockout_flag,
    COALESCE(CAST(dos AS DOUBLE), 0.0::DOUBLE) AS days_of_supply,
    CAST(date_diff('day', last_date, as_of) AS BIGINT) AS days_since_last_activity,
    CAST(d7 AS DOUBLE) / NULLIF(CAST(d30 - d7 AS DOUBLE), 0) AS demand_acceleration_ratio
  FROM magg WHERE d90 > 0 OR active_days > 0),
mvlt AS (
  SELECT s.as_of, p.vendor_id, p.sku_id,
    CAST(quantile_disc(date_diff('day', p.po_date, p.receipt_date), 0.5) AS BIGINT) AS p50,
    CAST(quantile_disc(date_diff('day', p.po_date, p.receipt_date), 0.9) AS BIGINT) AS p90,
    avg(CASE WHEN p.receipt_date > p.expected_date THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS late,
    COUNT(*) AS n
  FROM purchase_order_receipts_t p JOIN snaps s ON p.po_date BETWEEN s.as_of - 90 AND s.as_of
  GROUP BY s.as_of, p.vendor_id, p.sku_id),
msvm AS (
  SELECT as_of, sku_id, vendor_id FROM (
    SELECT s.as_of, t.sku_id, t.vendor_id, COUNT(*) AS c
    FROM tstaged t JOIN snaps s ON t.transaction_date BETWEEN s.as_of - 90 AND s.as_of
    WHERE t.vendor_id IS NOT NULL GROUP BY s.as_of, t.sku_id, t.vendor_id) x
  QUALIFY row_number() OVER (PARTITION BY as_of, sku_id ORDER BY c DESC, vendor_id) = 1),
mfeat AS (
  SELECT d.sku_id, m.vendor_id, d.signal_date AS feature_date, d.demand_7d, d.demand_30d, d.demand_90d,
    d.demand_cv_30d, d.demand_acceleration_ratio, d.days_of_supply, d.stockout_flag, d.stockout_days_30d,
    d.days_since_last_activity, COALESCE(v.p50, 14) AS lead_time_p50, COALESCE(v.p90, 21) AS lead_time_p90,
    COALESCE(v.late, 0.0::DOUBLE) AS late_delivery_rate, COALESCE(v.n, 0) AS po_count_90d,
    d.demand_30d / NULLIF(d.days_of_supply, 0) AS demand_pressure_ratio,
    CASE WHEN d.stockout_flag = 1 AND d.demand_acceleration_ratio > 1.2 THEN 1
         WHEN COALESCE(v.late, 0) > 0.25 THEN 1
         WHEN d.days_of_supply < COALESCE(v.p90, 21) THEN 1 ELSE 0 END AS supply_risk_flag,
    least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.3 * COALESCE(v.late, 0.0::DOUBLE) + 0.3 * (d.stockout_days_30d / 30.0::DOUBLE)
      + 0.2 * (1.0::DOUBLE - least(d.days_of_supply / 30.0::DOUBLE, 1.0::DOUBLE))
      + 0.2 * least(d.demand_cv_30d, 1.0::DOUBLE))) AS delay_risk_score
  FROM msig d LEFT JOIN msvm m ON d.sku_id = m.sku_id AND d.signal_date = m.as_of
  LEFT JOIN mvlt v ON d.sku_id = v.sku_id AND m.vendor_id = v.vendor_id AND d.signal_date = v.as_of),
eng AS (
  SELECT *,
    lead_time_p90 / greatest(CAST(lead_time_p50 AS DOUBLE), 1.0::DOUBLE) AS lead_time_buffer_ratio,
    days_of_supply / greatest(CAST(lead_time_p90 AS DOUBLE), 1.0::DOUBLE) AS inventory_coverage_ratio,
    demand_7d / greatest(CAST(demand_30d AS DOUBLE), 0.01::DOUBLE) AS demand_momentum,
    1.0::DOUBLE - late_delivery_rate AS vendor_reliability_score,
    COALESCE(demand_pressure_ratio, 0.0::DOUBLE) * 0.4 + stockout_flag * 0.3
      + (1.0::DOUBLE - COALESCE(least(days_of_supply / greatest(CAST(lead_time_p90 AS DOUBLE), 1.0::DOUBLE), 1.0::DOUBLE), 0.0::DOUBLE)) * 0.3
      AS composite_supply_pressure,
    concat_ws('|', sku_id, COALESCE(vendor_id, ''), CAST(feature_date AS VARCHAR)) AS rkey
  FROM mfeat),
lab AS (
  SELECT *, CASE WHEN CAST(('0x' || substr(md5('42:' || rkey), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.1
                 THEN 1 - rule ELSE rule END AS is_delayed
  FROM (SELECT *, CAST((supply_risk_flag = 1 OR late_delivery_rate > 0.2 OR stockout_flag = 1) AS INTEGER) AS rule FROM eng) r),
spl AS (
  SELECT *, CASE WHEN CAST(('0x' || substr(md5('42:' || CAST(is_delayed AS VARCHAR) || '#' || rkey), 1, 8)) AS BIGINT)
                      / 4294967296.0::DOUBLE < 0.2 THEN 'test' ELSE 'train' END AS split
  FROM lab),
test AS (SELECT *, supply_risk_flag AS prediction, delay_risk_score AS score FROM spl WHERE split = 'test'),
cm AS (SELECT CAST(count_if(is_delayed = 1 AND prediction = 1) AS BIGINT) AS tp,
              CAST(count_if(is_delayed = 0 AND prediction = 1) AS BIGINT) AS fp,
              CAST(count_if(is_delayed = 1 AND prediction = 0) AS BIGINT) AS fn,
              CAST(count_if(is_delayed = 0 AND prediction = 0) AS BIGINT) AS tn FROM test),
met AS (SELECT CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1_score,
               CASE WHEN tp + fp = 0 THEN 0.0 ELSE 1.0 * tp / (tp + fp) END AS precision,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE 1.0 * tp / (tp + fn) END AS recall,
               CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE 1.0 * (tp + tn) / (tp + fp + fn + tn) END AS accuracy,
               tp + fp + fn + tn AS n_samples FROM cm)"""


def training_po_cte(sku_mod: int = 50) -> str:
    return f""",
purchase_order_receipts_t AS (SELECT * FROM purchase_order_receipts)"""


def training_oracle(key: str, body: str) -> None:
    ORACLES[key] = with_fixtures(training_po_cte() + training_ctes() + "\n" + body)
