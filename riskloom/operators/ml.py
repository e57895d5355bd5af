"""Training data and model operators (Spark MLlib; no driver-side frames).

Labels, splits and class weights are column expressions and aggregates;
training is an MLlib ``Pipeline`` (VectorAssembler + RandomForest) fitted
on executors; the registry is a manifest table of saved models.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import md5_uniform
from riskloom.streaming.runner import materialize

# Model inputs and hyper-parameters.
FEATURE_COLUMNS = [
    "demand_7d", "demand_30d", "demand_90d", "demand_cv_30d", "demand_acceleration_ratio",
    "days_of_supply", "stockout_flag", "stockout_days_30d", "days_since_last_activity",
    "lead_time_p50", "lead_time_p90", "late_delivery_rate", "po_count_90d", "demand_pressure_ratio",
    "supply_risk_flag", "lead_time_buffer_ratio", "inventory_coverage_ratio", "demand_momentum",
    "vendor_reliability_score", "composite_supply_pressure",
]
SELECTED_COLUMNS = [
    "sku_id", "vendor_id", "feature_date", "demand_7d", "demand_30d", "demand_90d", "demand_cv_30d",
    "demand_acceleration_ratio", "days_of_supply", "stockout_flag", "stockout_days_30d",
    "days_since_last_activity", "lead_time_p50", "lead_time_p90", "late_delivery_rate", "po_count_90d",
    "demand_pressure_ratio", "supply_risk_flag", "delay_risk_score",
]
N_TREES, MAX_DEPTH, SEED, TEST_SIZE, FLIP_RATE = 100, 10, 42, 0.2, 0.1
LABEL = "is_delayed"


def _clip_lower(c, lo: float):
    return F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.greatest(F.col(c).cast("double"), F.lit(lo)))


def engineer(features: DataFrame) -> DataFrame:
    """The 18 selected columns (+ snapshot date) and 5 derived ratios."""
    f = features.select(*SELECTED_COLUMNS)
    cov = F.col("days_of_supply") / _clip_lower("lead_time_p90", 1.0)
    return f.withColumns({
        "lead_time_buffer_ratio": F.col("lead_time_p90") / _clip_lower("lead_time_p50", 1.0),
        "inventory_coverage_ratio": cov,
        "demand_momentum": F.col("demand_7d") / _clip_lower("demand_30d", 0.01),
        "vendor_reliability_score": F.lit(1.0) - F.col("late_delivery_rate"),
    }).withColumn(
        "composite_supply_pressure",
        F.coalesce(F.col("demand_pressure_ratio"), F.lit(0.0)) * F.lit(0.4)
        + F.col("stockout_flag") * F.lit(0.3)
        + (F.lit(1.0) - F.coalesce(F.least(F.col("inventory_coverage_ratio"), F.lit(1.0)), F.lit(0.0))) * F.lit(0.3))


def row_key(df: DataFrame) -> F.Column:
    return F.concat_ws("|", F.col("sku_id"), F.coalesce(F.col("vendor_id"), F.lit("")),
                       F.col("feature_date").cast("string"))


def label_synthetic(df: DataFrame, flip: float = FLIP_RATE, seed: int = SEED) -> DataFrame:
    """Rule label (risk flag, late rate > 0.2, stockout) with a seeded, hash-based 10 % flip."""
    rule = ((F.col("supply_risk_flag") == 1) | (F.col("late_delivery_rate") > 0.2)
            | (F.col("stockout_flag") == 1)).cast("int")
    u = md5_uniform(row_key(df), seed)
    return df.withColumn(LABEL, F.when(u < F.lit(flip), F.lit(1) - rule).otherwise(rule))


def label_from_outcomes(features: DataFrame, outcomes: DataFrame, horizon_days: int = 30) -> DataFrame:
    """is_delayed = a PO of the (sku, vendor) placed in (feature_date, feature_date + horizon] arrived late.

    Works for any feature dates. Outcomes are counted per (sku, vendor, day)
    first; each day is matched with the feature dates whose horizon covers
    it by an equi-join with the distinct feature dates (calendar days, a
    bounded list), so there is no range join; then one equi-join with the
    features. Feature rows without outcomes get 0.
    """
    late = (F.col("receipt_date") > F.col("expected_date")).cast("int")
    days = (outcomes.groupBy("sku_id", "vendor_id", "po_date")
            .agg(F.max(late).alias("late"), F.count(F.lit(1)).alias("n")))
    dates = F.broadcast(features.select("feature_date").distinct())
    o = (days.withColumn("feature_date", F.explode(F.sequence(F.date_sub("po_date", horizon_days), F.date_sub("po_date", 1))))
         .join(dates, "feature_date")
         .groupBy("sku_id", "vendor_id", "feature_date")
         .agg(F.max("late").alias("__late"), F.sum("n").alias("outcome_pos")))
    return (features.join(o, ["sku_id", "vendor_id", "feature_date"], "left")
            .withColumn(LABEL, F.coalesce("__late", F.lit(0)))
            .withColumn("outcome_pos", F.coalesce("outcome_pos", F.lit(0)).cast("long"))
            .drop("__late"))


def stratified_split(df: DataFrame, label: str = LABEL, test_size: float = TEST_SIZE,
                     seed: int = SEED) -> DataFrame:
    """split = 'test' / 'train' from a per-row hash salted by the class (no shuffle, deterministic)."""
    u = md5_uniform(F.concat_ws("#", F.col(label).cast("string"), row_key(df)), seed)
    return df.withColumn("split", F.when(u < F.lit(test_size), F.lit("test")).otherwise(F.lit("train")))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (k * n_c) per class (k = number of classes present)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    n = df.agg(F.count(F.lit(1))).scalar()
    k = c.agg(F.count(F.lit(1))).scalar()
    return c.select(label, "n_class", (n / (k * F.col("n_class"))).alias("weight"))


def with_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    w = class_weights(df, label).select(label, "weight")
    return df.join(w, label, "left")


def train(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = LABEL,
          trees: int = N_TREES, depth: int = MAX_DEPTH, seed: int = SEED, weighted: bool = True):
    """MLlib random forest on fillna(0) features with balanced class weights."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    data = df.na.fill(0.0, list(features)).na.fill(0, list(features))
    if weighted:
        data = with_weights(data, label)
    # The forest makes many passes: materialise the training set once in the
    # shared checkpoint folder (reliable; survives executor loss) instead of
    # re-running the feature lineage on every pass.
    data = materialize(data, "weighted")
    asm = VectorAssembler(inputCols=list(features), outputCol="features_vec", handleInvalid="keep")
    kw = {"weightCol": "weight"} if weighted else {}
    rf = RandomForestClassifier(featuresCol="features_vec", labelCol=label, numTrees=trees, maxDepth=depth,
                                seed=seed, featureSubsetStrategy="sqrt", **kw)
    return Pipeline(stages=[asm, rf]).fit(data.withColumn(label, F.col(label).cast("double")))


def score(model, df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """prediction (0/1) and score = P(class 1) from a fitted pipeline."""
    from pyspark.ml.functions import vector_to_array
    data = df.na.fill(0.0, list(features)).na.fill(0, list(features))
    out = model.transform(data)
    return (out.withColumn("score", vector_to_array("probability")[1])
            .withColumn("prediction", F.col("prediction").cast("int"))
            .drop("features_vec", "rawPrediction", "probability"))


def importance(model, features: Sequence[str] = FEATURE_COLUMNS) -> list[tuple[str, float]]:
    """(feature, importance) pairs from the forest (a vector of len(features) on the driver)."""
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray()
    return [(f, float(v)) for f, v in zip(features, imp)]


def latest_model(registry: DataFrame, name: str) -> DataFrame:
    """Newest registered model of ``name`` (top-1 by creation time)."""
    return (registry.where(F.col("model_name") == name)
            .orderBy(F.col("created_at").desc(), F.col("model_path").desc()).limit(1))
