"""Registered queries: feature store, training data, model, evaluation, pipeline run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import evaluation as evl
from riskloom.operators import featurestore as fs
from riskloom.operators import ml
from riskloom.plans.context import Inputs
from riskloom.plans.oracle import AS_OF, ORACLES, RUN_ID, oracle, r6, training_oracle
from riskloom.plans.registry import query
from riskloom.plans.stored import stored_path
from riskloom.sources.sinks import write_predictions
from riskloom.streaming.runner import materialize
from riskloom.session import shared_dir
from riskloom.sources import fixtures as fx
from riskloom.streaming import events as ev

FRESHNESS_NOW = dt.datetime(2001, 8, 2, 7, 0, 0)


def _lines(x: Inputs) -> DataFrame:
    li = x.table("lineitem")
    return li.select(F.concat(F.lit("V-"), (F.col("l_suppkey") % 10).cast("string")).alias("vendor_id"),
                     (F.col("l_returnflag") == "R").cast("int").alias("returned"),
                     F.to_date("l_shipdate").alias("line_date"))


# ---------------------------------------------------------------- entities
@query("entity_sku")
def _entity_sku(x: Inputs) -> DataFrame:
    return fs.entity_sku(x.features_table)


oracle("entity_sku", f"""SELECT sku_id, {r6('CAST(demand_7d AS DOUBLE)', 'demand_7d')}, {r6('CAST(demand_30d AS DOUBLE)', 'demand_30d')},
  {r6('CAST(demand_90d AS DOUBLE)', 'demand_90d')}, CAST(stockout_flag AS BIGINT) AS stockout_flag,
  {r6('days_of_supply', 'days_of_supply')}, {r6('delay_risk_score', 'delay_risk_score')}, feature_date FROM features""")


@query("entity_vendor")
def _entity_vendor(x: Inputs) -> DataFrame:
    return fs.entity_vendor(x.po, x.as_of)


_VENDOR_SQL = f""", vg AS (
  SELECT vendor_id, CAST(quantile_disc(lead_days, 0.5) AS DOUBLE) AS lead_time_p50,
    CAST(quantile_disc(lead_days, 0.9) AS DOUBLE) AS lead_time_p90, avg(is_late) AS late_delivery_rate,
    COUNT(*) AS po_count_90d FROM lead_rows GROUP BY vendor_id)"""
oracle("entity_vendor", _VENDOR_SQL + f"""
SELECT vendor_id, lead_time_p50, lead_time_p90, {r6('late_delivery_rate', 'late_delivery_rate')}, po_count_90d,
  {AS_OF} AS feature_date FROM vg""")


@query("entity_vendor_as_written")
def _entity_vendor_as_written(x: Inputs) -> DataFrame:
    return fs.entity_vendor_as_written(x.features_table)


oracle("entity_vendor_as_written", f"""SELECT vendor_id, sku_id, CAST(lead_time_p50 AS DOUBLE) AS lead_time_p50,
  CAST(lead_time_p90 AS DOUBLE) AS lead_time_p90, {r6('late_delivery_rate', 'late_delivery_rate')}, po_count_90d,
  feature_date FROM features""")


@query("entity_sku_ext")
def _entity_sku_ext(x: Inputs) -> DataFrame:
    return fs.entity_sku_ext(x.features_table)


oracle("entity_sku_ext", f"""SELECT sku_id, {r6('stockout_days_30d / 30.0::DOUBLE', 'stockout_rate')},
  {r6('days_of_supply', 'avg_inventory_days')}, feature_date FROM features""")


@query("entity_vendor_ext")
def _entity_vendor_ext(x: Inputs) -> DataFrame:
    return fs.entity_vendor_ext(x.po, _lines(x), x.as_of)


oracle("entity_vendor_ext", _VENDOR_SQL + f""", dr AS (
  SELECT 'V-' || CAST(l_suppkey % 10 AS VARCHAR) AS vendor_id, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS defect_rate
  FROM lineitem WHERE CAST(l_shipdate AS DATE) <= {AS_OF} GROUP BY 1)
SELECT vendor_id, {r6('1.0::DOUBLE - late_delivery_rate', 'on_time_rate')},
  {r6('COALESCE(CAST(dr.defect_rate AS DOUBLE), 0.0)', 'defect_rate')}, {AS_OF} AS feature_date
FROM vg FULL JOIN dr USING (vendor_id)""")


@query("entity_order")
def _entity_order(x: Inputs) -> DataFrame:
    return fs.entity_order(x.table("orders"), x.po, x.as_of)


oracle("entity_order", f""", o AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) <= {AS_OF}),
lt AS (SELECT order_key AS k, max(date_diff('day', po_date, expected_date)) AS rl
       FROM purchase_order_receipts GROUP BY 1),
bl AS (SELECT o_custkey, COUNT(*) AS b FROM o WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT o.o_orderkey AS order_id, CAST(date_diff('day', CAST(o.o_orderdate AS DATE), {AS_OF}) AS BIGINT) AS days_since_order,
  CAST(lt.rl AS BIGINT) AS requested_lead_time, CAST(COALESCE(bl.b, 0) AS BIGINT) AS backlog_depth, {AS_OF} AS feature_date
FROM o LEFT JOIN lt ON o.o_orderkey = lt.k LEFT JOIN bl ON o.o_custkey = bl.o_custkey""")


@query("entity_customer")
def _entity_customer(x: Inputs) -> DataFrame:
    return fs.entity_customer(x.table("customer"), x.table("orders"), x.as_of)


oracle("entity_customer", f""", r AS (
  SELECT o_custkey, COUNT(*) AS n, avg(o_totalprice) AS aov FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN {AS_OF} - 365 AND {AS_OF} GROUP BY 1)
SELECT c_custkey AS customer_id, {r6('COALESCE(r.n, 0) * 30.0::DOUBLE / 365.0::DOUBLE', 'order_frequency')},
  {r6('r.aov', 'avg_order_value')}, {r6('least(1.0::DOUBLE, greatest(0.0::DOUBLE, -c_acctbal / 1000.0::DOUBLE))', 'payment_risk_score')},
  {AS_OF} AS feature_date
FROM customer LEFT JOIN r ON customer.c_custkey = r.o_custkey""")


@query("feature_sync")
def _feature_sync(x: Inputs) -> DataFrame:
    return fs.sync("sku", fs.entity_sku(x.features_table), shared_dir(x.spark, "offline-store"))


oracle("feature_sync", "SELECT 'sku' AS entity_type, feature_date, COUNT(*) AS records_synced FROM features GROUP BY feature_date")


@query("feature_lookup")
def _feature_lookup(x: Inputs) -> DataFrame:
    """Features of every SKU seen in the valid event stream (ids as a DataFrame)."""
    ids = ev.ingest_events(x.messages, x.run_id, x.run_ts).where(F.col("is_valid")).select("sku_id")
    return fs.lookup("sku", fs.entity_sku(x.features_table), ids)


oracle("feature_lookup", f"""SELECT sku_id, {r6('CAST(demand_7d AS DOUBLE)', 'demand_7d')},
  {r6('CAST(demand_30d AS DOUBLE)', 'demand_30d')}, {r6('CAST(demand_90d AS DOUBLE)', 'demand_90d')},
  CAST(stockout_flag AS BIGINT) AS stockout_flag, {r6('days_of_supply', 'days_of_supply')},
  {r6('delay_risk_score', 'delay_risk_score')}
FROM features WHERE sku_id IN (
  SELECT json_extract_string(data, '$.sku_id') FROM event_messages
  WHERE json_valid(data) AND json_extract_string(data, '$.transaction_id') IS NOT NULL
    AND json_extract_string(data, '$.quantity') IS NOT NULL AND json_extract_string(data, '$.event_type') IS NOT NULL)""")


@query("feature_freshness")
def _feature_freshness(x: Inputs) -> DataFrame:
    return fs.freshness(x.features_table, FRESHNESS_NOW)


oracle("feature_freshness", f"""SELECT 'sku' AS entity_type, MAX(feature_date) AS latest_feature_date,
  MAX(computed_at) AS latest_computed_at, COUNT(*) AS total_entities,
  ROUND(date_diff('second', MAX(computed_at), TIMESTAMP '2001-08-02 07:00:00') / 3600.0, 1) AS hours_stale,
  MAX(computed_at) IS NULL OR ROUND(date_diff('second', MAX(computed_at), TIMESTAMP '2001-08-02 07:00:00') / 3600.0, 1) > 25.0 AS is_stale
FROM features""")


@query("point_in_time_features")
def _pit(x: Inputs) -> DataFrame:
    """Each PO (label row) gets the newest training snapshot of its SKU dated on or before the PO."""
    f = x.training_table.select("sku_id", "feature_date", "delay_risk_score", "days_of_supply")
    labels = x.training_po.select("po_id", "sku_id", F.col("po_date").alias("label_date"))
    return fs.point_in_time(f, labels, "sku_id", "feature_date", "label_date").select(
        "po_id", "sku_id", "label_date", "feature_date", "delay_risk_score", "days_of_supply")


training_oracle("point_in_time_features", f"""
SELECT p.po_id, p.sku_id, p.po_date AS label_date, f.feature_date, {r6('f.delay_risk_score', 'delay_risk_score')},
  {r6('f.days_of_supply', 'days_of_supply')}
FROM purchase_order_receipts p ASOF LEFT JOIN mfeat f ON p.sku_id = f.sku_id AND p.po_date >= f.feature_date""")


# ---------------------------------------------------------------- training data
def _labeled(x: Inputs) -> DataFrame:
    return ml.label_synthetic(ml.engineer(x.training_table))


def _split(x: Inputs) -> DataFrame:
    return ml.stratified_split(_labeled(x))


def _split_cut(x: Inputs) -> DataFrame:
    """The split training set materialised once (lineage cut) for multi-pass model fitting."""
    return materialize(_split(x), "split")


def _rule_test(x: Inputs) -> DataFrame:
    """Hold-out rows scored by the rule model (prediction = supply_risk_flag, score = risk score)."""
    return (_split(x).where(F.col("split") == "test")
            .withColumn("prediction", F.col("supply_risk_flag")).withColumn("score", F.col("delay_risk_score")))


ENG_COLS = ml.SELECTED_COLUMNS + ["lead_time_buffer_ratio", "inventory_coverage_ratio", "demand_momentum",
                                  "vendor_reliability_score", "composite_supply_pressure"]
_INT_COLS = {"sku_id", "vendor_id", "feature_date", "demand_7d", "demand_30d", "demand_90d", "stockout_flag",
             "stockout_days_30d", "days_since_last_activity", "lead_time_p50", "lead_time_p90", "po_count_90d",
             "supply_risk_flag"}


def _eng_select(prefix: str = "") -> str:
    return ", ".join(c if c in _INT_COLS else r6(prefix + c, c) for c in ENG_COLS)


@query("engineered_features")
def _engineered(x: Inputs) -> DataFrame:
    return ml.engineer(x.training_table)


training_oracle("engineered_features", f"SELECT {_eng_select()} FROM eng")


@query("label_synthetic")
def _label_synthetic(x: Inputs) -> DataFrame:
    return _labeled(x).select("sku_id", "vendor_id", "feature_date", "supply_risk_flag", ml.LABEL)


training_oracle("label_synthetic", "SELECT sku_id, vendor_id, feature_date, supply_risk_flag, is_delayed FROM lab")


@query("label_from_outcomes")
def _label_outcomes(x: Inputs) -> DataFrame:
    f = x.training_table.select("sku_id", "vendor_id", "feature_date")
    return ml.label_from_outcomes(f, x.training_po, horizon_days=30)


training_oracle("label_from_outcomes", """
SELECT f.sku_id, f.vendor_id, f.feature_date, COALESCE(MAX(CASE WHEN p.receipt_date > p.expected_date THEN 1 ELSE 0 END), 0) AS is_delayed,
  COUNT(p.po_id) AS outcome_pos
FROM mfeat f LEFT JOIN purchase_order_receipts p ON p.sku_id = f.sku_id AND p.vendor_id = f.vendor_id
  AND p.po_date > f.feature_date AND p.po_date <= f.feature_date + 30
GROUP BY f.sku_id, f.vendor_id, f.feature_date""")


@query("stratified_split")
def _stratified(x: Inputs) -> DataFrame:
    return _split(x).groupBy(ml.LABEL, "split").agg(F.count(F.lit(1)).alias("n_rows"))


training_oracle("stratified_split", "SELECT is_delayed, split, COUNT(*) AS n_rows FROM spl GROUP BY 1, 2")


@query("class_weights")
def _class_weights(x: Inputs) -> DataFrame:
    return ml.class_weights(_split(x).where(F.col("split") == "train"))


training_oracle("class_weights", f"""SELECT is_delayed, COUNT(*) AS n_class,
  {r6('(SELECT COUNT(*) FROM spl WHERE split = \'train\') / ((SELECT COUNT(DISTINCT is_delayed) FROM spl WHERE split = \'train\') * COUNT(*))', 'weight')}
FROM spl WHERE split = 'train' GROUP BY is_delayed""")


# ---------------------------------------------------------------- evaluation
@query("classification_metrics")
def _metrics(x: Inputs) -> DataFrame:
    return evl.metrics(_rule_test(x))


training_oracle("classification_metrics", f"""SELECT {r6('f1_score', 'f1_score')}, {r6('precision', 'precision')},
  {r6('recall', 'recall')}, {r6('accuracy', 'accuracy')}, n_samples FROM met""")


@query("confusion_matrix")
def _confusion(x: Inputs) -> DataFrame:
    return evl.confusion(_rule_test(x))


training_oracle("confusion_matrix", """SELECT 0 AS label, 0 AS prediction, tn AS n FROM cm
UNION ALL SELECT 0, 1, fp FROM cm UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm""")


@query("classification_report")
def _report(x: Inputs) -> DataFrame:
    return evl.report(_rule_test(x))


training_oracle("classification_report", """, pc AS (
  SELECT '0' AS class, CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p,
    CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r, tn + fp AS support FROM cm
  UNION ALL
  SELECT '1', CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, tp + fn FROM cm),
pcf AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM pc)
SELECT class, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM pcf
UNION ALL SELECT 'accuracy', ROUND(accuracy, 6), ROUND(accuracy, 6), ROUND(accuracy, 6), n_samples FROM met
UNION ALL SELECT 'macro avg', ROUND(avg(p), 6), ROUND(avg(r), 6), ROUND(avg(f), 6), CAST(SUM(support) AS BIGINT) FROM pcf
UNION ALL SELECT 'weighted avg', ROUND(SUM(p * support) / SUM(support), 6), ROUND(SUM(r * support) / SUM(support), 6),
  ROUND(SUM(f * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM pcf""")


@query("roc_auc")
def _roc_auc(x: Inputs) -> DataFrame:
    return evl.roc_auc(_rule_test(x))


training_oracle("roc_auc", f""", g AS (SELECT score AS s, count_if(is_delayed = 1) AS pos, count_if(is_delayed = 0) AS neg FROM test GROUP BY 1),
c AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT {r6('SUM(pos * (below + 0.5 * neg)) / (SUM(pos) * SUM(neg))', 'roc_auc')}, CAST(SUM(pos) AS BIGINT) AS n_pos,
  CAST(SUM(neg) AS BIGINT) AS n_neg FROM c""")


@query("promotion_gate")
def _gate(x: Inputs) -> DataFrame:
    return evl.gate(evl.metrics(_rule_test(x)))


training_oracle("promotion_gate", f"""SELECT {r6('f1_score', 'candidate_f1')}, 0.75::DOUBLE AS threshold_f1, 0.72::DOUBLE AS baseline_f1,
  f1_score > 0.72 AS beats_baseline, f1_score >= 0.75 AS meets_threshold, f1_score >= 0.75 AND f1_score > 0.72 AS passed,
  ROUND(ROUND(f1_score - 0.72, 4), 6) AS improvement_over_baseline FROM met""")


# ---------------------------------------------------------------- model (rows-only checks)
@query("train_delay_model")
def _train(x: Inputs) -> DataFrame:
    sp = _split_cut(x)
    model = ml.train(sp.where(F.col("split") == "train"))
    return ml.score(model, sp.where(F.col("split") == "test")).select(
        "sku_id", "vendor_id", "feature_date", ml.LABEL, "prediction", "score")


@query("feature_importance")
def _importance(x: Inputs) -> DataFrame:
    sp = _split_cut(x)
    model = ml.train(sp.where(F.col("split") == "train"))
    return x.spark.createDataFrame(ml.importance(model), "feature string, importance double")


@query("training_run_report")
def _training_run(x: Inputs) -> DataFrame:
    from riskloom.plans.training import run_training
    return run_training(x.spark, x.training_table, shared_dir(x.spark, "model-registry"), x.run_id, x.run_ts)


def _registry(x: Inputs) -> str:
    """The session's model registry; a training run fills it once, apart from any scoring.

    A run whose model fails its gate leaves its report and no current version.
    """
    def fill(path: str) -> None:
        from riskloom.plans.training import run_training
        run_training(x.spark, x.training_table, path, x.run_id, x.run_ts)
    sources = [f"{x.sf_dir}/{t}.parquet" for t in ("lineitem", "orders")]
    return stored_path(x.spark, f"model-registry-{x.sku_mod}", sources, fill)


@query("batch_score_model")
def _batch_score(x: Inputs) -> DataFrame:
    """The registry's current model (the rules, while none passed its gate) over the latest features, as JSON Lines read back."""
    from riskloom.plans.training import score_latest
    out = shared_dir(x.spark, "predictions")
    scores = score_latest(x.spark, _registry(x), ml.engineer(x.features_table), x.run_ts)
    write_predictions(scores, out)
    return x.spark.read.schema(scores.schema).json(out)


@query("pipeline_report")
def _pipeline_report(x: Inputs) -> DataFrame:
    from riskloom.plans.pipeline import run_pipeline
    report = run_pipeline(x.spark, x.raw, fx.po_batches(x.raw_po, x.as_of), shared_dir(x.spark, "layers"), x.as_of,
                          x.run_ts, x.run_id)
    return report.select("step", "table", "row_count", "min_rows", "passed", "pipeline_run_id")


oracle("pipeline_report", f"""
SELECT 'staging' AS step, 'staging.inventory_transactions' AS "table", COUNT(*) AS row_count, CAST(1 AS BIGINT) AS min_rows,
  COUNT(*) >= 1 AS passed, {RUN_ID} AS pipeline_run_id FROM staged
UNION ALL SELECT 'purchase_orders', 'staging.purchase_orders', COUNT(*), 1, COUNT(*) >= 1, 'pipeline-20010801-060000' FROM purchase_order_receipts
UNION ALL SELECT 'demand_signals', 'analytics.demand_signals_by_sku', COUNT(*), 1, COUNT(*) >= 1, 'pipeline-20010801-060000' FROM signals_w
UNION ALL SELECT 'sku_risk_features', 'ml_features.sku_risk_features', COUNT(*), 1, COUNT(*) >= 1, 'pipeline-20010801-060000' FROM features
UNION ALL SELECT 'delay_risk_scores', 'analytics.delay_risk_scores', COUNT(*), 1, COUNT(*) >= 1, 'pipeline-20010801-060000' FROM features""")


@query("po_layer_upsert")
def _po_layer(x: Inputs) -> DataFrame:
    """The purchase-order layer after a batch with late receipts, and what each upsert did to it (summed per order row)."""
    from riskloom.plans.pipeline import upsert_purchase_orders
    path, fates = shared_dir(x.spark, "po-layer"), []
    first, late = fx.po_batches(x.raw_po_table, x.as_of)
    for batch in (first, late, late):  # the last one again: nothing changes
        fates.append(upsert_purchase_orders(x.spark, batch, path))
    report = None
    for step, fate in enumerate(fates, 1):
        row = fate.select(F.lit(step).alias("step"), "*")
        report = row if report is None else report.unionByName(row)
    rows = x.spark.read.parquet(path)
    totals = {"n_orders": F.count(F.lit(1)), "n_received": F.count("receipt_date"), "sum_lead_days": F.sum("lead_days"),
              "n_months": F.count_distinct("po_month")}
    return report.select("*", *[rows.agg(f).scalar().alias(name) for name, f in totals.items()])


oracle("po_layer_upsert", f"""
, late AS (SELECT * FROM raw_po WHERE receipt_date > {AS_OF} - {fx.LATE_DAYS}),
totals AS (SELECT COUNT(*) AS n_orders, COUNT(receipt_date) AS n_received,
    CAST(SUM(date_diff('day', po_date, receipt_date)) AS BIGINT) AS sum_lead_days, COUNT(DISTINCT date_trunc('month', po_date)) AS n_months
  FROM purchase_order_receipts),
l AS (SELECT COUNT(DISTINCT po_id) AS n, COUNT(DISTINCT date_trunc('month', po_date)) AS m FROM late),
steps AS (SELECT 1 AS step, n_orders AS rows_in, n_orders AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged,
    n_months AS partitions_rewritten, CAST(0 AS BIGINT) AS partitions_removed FROM totals
  UNION ALL SELECT 2, n, 0, n, 0, m, 0 FROM l
  UNION ALL SELECT 3, n, 0, 0, n, m, 0 FROM l)
SELECT steps.*, totals.* FROM steps, totals""")


@query("sql_template_chain")
def _sql_template_chain(x: Inputs) -> DataFrame:
    """The chain run from the named SQL templates, every step a written table: the scores."""
    from riskloom.plans.templates import chain_values, run_chain
    made = run_chain(x.spark, x.raw, x.po, shared_dir(x.spark, "template-chain"), chain_values(x.as_of, x.run_ts, x.run_id))
    return made["scores"]


ORACLES["sql_template_chain"] = ORACLES["delay_risk_scores"]
