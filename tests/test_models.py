"""Model registry: versions, one current record, two writers, checked loading."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluation as evl
from riskloom.operators import ml
from riskloom.plans.models import Conflict, Current, ModelMismatch, ModelRegistry
from riskloom.session import shared_dir
from riskloom.streaming.runner import materialize

TS = dt.datetime(2001, 8, 1)


@pytest.fixture(scope="module")
def fitted(spark):
    """A small model and its hold-out rows."""
    rows = spark.range(300).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(ml.FEATURE_COLUMNS)],
                                   ((F.col("id") * 3) % 17 > 8).cast("int").alias(ml.LABEL), "id")
    rows = materialize(rows, "registry-rows")
    model = ml.train(rows.where("id < 200").drop("id"), trees=4, depth=3)
    holdout = rows.where("id >= 200").drop("id")
    f1 = evl.metrics(ml.score(model, holdout)).first().f1_score
    return model, holdout, float(f1)


def register(registry, fitted, run_id, f1=None):
    model, holdout, true_f1 = fitted
    return registry.register("m", model, holdout, run_id, true_f1 if f1 is None else f1, dt.date(2001, 8, 1), TS)


def test_current_moves_step_by_step(spark, fitted):
    r = ModelRegistry(spark, shared_dir(spark, "models"))
    assert r.current("m") == Current(0, None)
    with pytest.raises(ValueError):
        r.load("m")
    a = register(r, fitted, "a")
    assert r.current("m").version is None  # registered is not yet current
    one = r.make_current("m", a, r.current("m"))
    b = register(r, fitted, "b")
    two = r.make_current("m", b, one)
    assert r.current("m") == two == Current(2, b)
    model, entry = r.load("m")
    assert entry.version == b and abs(entry.f1_score - fitted[2]) < 1e-12 and model.stages
    assert r.make_current("m", a, two).number == 3  # back to an older version
    assert r.load("m")[1].run_id == "a"
    with pytest.raises(ValueError):
        r.make_current("m", "unregistered", r.current("m"))


def test_of_two_writers_one_wins(spark, fitted):
    root = shared_dir(spark, "models")
    first, second = ModelRegistry(spark, root), ModelRegistry(spark, root)
    a, b = register(first, fitted, "a"), register(second, fitted, "b")
    seen_first, seen_second = first.current("m"), second.current("m")
    second.make_current("m", b, seen_second)
    with pytest.raises(Conflict):
        first.make_current("m", a, seen_first)
    assert first.current("m") == Current(1, b)
    assert first.make_current("m", a, first.current("m")) == Current(2, a)
    assert first.manifest().count() == 2  # no version is lost


def test_a_model_that_is_not_what_its_row_says_is_refused(spark, fitted):
    r = ModelRegistry(spark, shared_dir(spark, "models"))
    wrong = register(r, fitted, "a", f1=fitted[2] / 2)
    r.make_current("m", wrong, r.current("m"))
    with pytest.raises(ModelMismatch):
        r.load("m")
    assert r.load("m", check=False)[1].version == wrong


def test_scoring_trains_nothing(spark, monkeypatch):
    import __spark_entry__ as se
    score = se.queries()["batch_score_model"]
    assert score(spark, "/root/testdata/sf0.001").count() > 0  # fills the session's registry if need be
    monkeypatch.setattr(ml, "train", lambda *a, **k: pytest.fail("scoring trains"))
    assert score(spark, "/root/testdata/sf0.001").count() > 0
