"""Gated training run: validate -> (gate) -> engineer -> label -> split -> train -> evaluate -> gate -> register.

A plain driver function chaining Spark jobs. Only report-sized results
(one metrics row, one verdict) reach the driver; data stays in Spark.
Versions and the record of the current one are in ``models``; scoring only
loads, it never trains.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import risk_level
from riskloom.operators import evaluation as evl
from riskloom.operators import ml
from riskloom.operators.quality import validate_features
from riskloom.operators.scoring import read_latest_snapshot
from riskloom.plans.models import ModelRegistry
from riskloom.sources.fixtures import run_ts_lit
from riskloom.sources.sinks import write_report
from riskloom.streaming.runner import materialize

MODEL_NAME = "delay_risk_rf"
REPORT_SCHEMA = ("run_id string, validation_passed boolean, train_rows bigint, test_rows bigint, "
                 "f1_score double, precision double, recall double, accuracy double, roc_auc double, "
                 "gate_passed boolean, registered boolean, model_path string")


def run_training(spark: SparkSession, features: DataFrame, registry: str, run_id: str, run_ts: dt.datetime,
                 threshold: float = evl.THRESHOLD_F1, baseline: float = evl.BASELINE_F1) -> DataFrame:
    verdict = validate_features(read_latest_snapshot(features)).where(F.col("check") == "verdict").first()
    validation_passed = bool(verdict["passed"]) if verdict else False
    if not validation_passed:
        # The chain stops at the first gate: no training on a table that failed validation.
        return spark.createDataFrame([(run_id, False, 0, 0, None, None, None, None, None, False, False, None)],
                                     REPORT_SCHEMA)
    snapshot = features.agg(F.max("feature_date")).first()[0]
    data = materialize(ml.stratified_split(ml.label_synthetic(ml.engineer(features))), "training-set")
    train_df = data.where(F.col("split") == "train")
    test_df = data.where(F.col("split") == "test")
    model = ml.train(train_df)
    # Scored once: the metrics, the AUC and the gate read the stored scores.
    scored = materialize(ml.score(model, test_df).select(ml.LABEL, "prediction", "score"), "scored")
    metrics = evl.metrics(scored)
    m, auc, g = metrics.first(), evl.roc_auc(scored).first(), evl.gate(metrics, threshold, baseline).first()
    sizes = data.groupBy("split").count().collect()
    n = {r["split"]: r["count"] for r in sizes}
    registered = bool(g["passed"])
    path = None
    if registered:
        models = ModelRegistry(spark, registry)
        seen = models.current(MODEL_NAME)
        version = models.register(MODEL_NAME, model, test_df, run_id, float(m["f1_score"]), snapshot, run_ts)
        models.make_current(MODEL_NAME, version, seen)
        path = f"{registry.rstrip('/')}/models/{MODEL_NAME}/{version}"
    row = (run_id, validation_passed, int(n.get("train", 0)), int(n.get("test", 0)), float(m["f1_score"]),
           float(m["precision"]), float(m["recall"]), float(m["accuracy"]),
           float(auc["roc_auc"]) if auc and auc["roc_auc"] is not None else None,
           bool(g["passed"]), registered, path)
    # The report of every run is kept beside the models, as JSON Lines, and read back from there.
    path = write_report(spark.createDataFrame([row], REPORT_SCHEMA), f"{registry.rstrip('/')}/reports/{run_id}")
    return spark.read.schema(REPORT_SCHEMA).json(path)


def score_latest(spark: SparkSession, registry: str, engineered: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Score the newest feature snapshot with the current model, whose F1 is checked against its manifest row.

    While no model has passed its gate there is no current one: the rows then carry the rule-based score and
    flag of their snapshot. ``method`` says which it was, ``model`` or ``rules``.
    """
    models = ModelRegistry(spark, registry)
    snap = read_latest_snapshot(engineered)
    if models.current(MODEL_NAME).version is None:
        out = snap.select("*", F.col("delay_risk_score").alias("score"),
                          F.col("supply_risk_flag").cast("int").alias("prediction"), F.lit("rules").alias("method"))
    else:
        model, _ = models.load(MODEL_NAME)
        out = ml.score(model, snap).withColumn("method", F.lit("model"))
    return out.select("sku_id", "vendor_id", F.col("score").alias("risk_score"),
                      risk_level("score").alias("risk_level"), "prediction",
                      F.col("feature_date").alias("score_date"), run_ts_lit(run_ts).alias("scored_at"), "method")
