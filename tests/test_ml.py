from pyspark.sql import functions as F

from riskloom.operators import ml
from riskloom.plans.training import run_training, score_latest
from riskloom.session import shared_dir


def test_training_run_and_batch_score(spark, x001):
    feats = x001.training_features
    reg = shared_dir(spark, "reg")
    rep = run_training(spark, feats, reg, "run-1", x001.run_ts, threshold=0.0, baseline=-1.0).first()
    assert rep.train_rows > 0 and rep.test_rows > 0 and rep.registered
    assert 0.0 <= rep.f1_score <= 1.0
    scored = score_latest(spark, reg, ml.engineer(x001.features), x001.run_ts)
    assert scored.count() == x001.features.count()
    assert scored.where((F.col("risk_score") < 0) | (F.col("risk_score") > 1)).count() == 0


def test_label_rate_in_training_fixture(x01):
    lab = ml.label_synthetic(ml.engineer(x01.training_features))
    r = lab.agg(F.count(F.lit(1)).alias("n"), F.avg("is_delayed").alias("rate")).first()
    assert r.n > 3000 and 0.3 < r.rate < 0.9


def test_failed_validation_stops_the_chain(spark, x001):
    bad = x001.training_features.withColumn("lead_time_p90", F.lit(None).cast("long"))
    rep = run_training(spark, bad, shared_dir(spark, "reg-bad"), "run-bad", x001.run_ts).first()
    assert rep.validation_passed is False and rep.registered is False and rep.train_rows == 0


def test_model_keys_after_pipeline_report(spark):
    """Order used by the correctness run: the pipeline report, then a model key, in one session."""
    import __spark_entry__ as se
    q = se.queries()
    assert q["pipeline_report"](spark, "/root/testdata/sf0.001").count() == 5
    assert q["batch_score_model"](spark, "/root/testdata/sf0.001").count() > 0


def test_without_a_model_that_passed_its_gate_the_rules_score(spark, x001, monkeypatch):
    """At 6 times sf0.1 the forest's F1 is below the gate: nothing is registered, and scoring still answers."""
    import __spark_entry__ as se
    from riskloom.operators import evaluation as evl
    from riskloom.operators.scoring import delay_risk_scores
    from riskloom.plans import stored
    monkeypatch.setattr(stored, "_TABLES", {})
    monkeypatch.setattr(evl, "gate", lambda m, *a: m.select("f1_score", F.lit(False).alias("passed")))
    got = se.queries()["batch_score_model"]
    rows = {r.sku_id: r for r in got(spark, "/root/testdata/sf0.001").collect()}
    rules = delay_risk_scores(x001.features, x001.run_ts).collect()
    assert len(rows) == len(rules) > 0
    for r in rules:
        s = rows[r.sku_id]
        assert (s.method, s.prediction, s.risk_level, s.score_date) == ("rules", r.supply_risk_flag, r.risk_level, r.score_date)
        assert abs(s.risk_score - r.risk_score) < 1e-6
    monkeypatch.setattr(ml, "train", lambda *a, **k: 1 / 0)  # the run's report is kept: no second training
    assert got(spark, "/root/testdata/sf0.001").count() == len(rules)
