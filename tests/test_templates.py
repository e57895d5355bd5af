"""Named SQL templates: the same tables as the DataFrame chain; values stay values; templates can be replaced."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskloom.operators.scoring import delay_risk_scores
from riskloom.plans.templates import Templates, UnknownTemplate, chain_values, run_chain
from riskloom.session import shared_dir


def same(a, b):
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in b.dtypes]
    a, b = a.select(*rounded), b.select(*rounded)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_chain_equals_the_dataframe_chain(spark, x001):
    values = chain_values(x001.as_of, x001.run_ts, x001.run_id)
    made = run_chain(spark, x001.raw, x001.po, shared_dir(spark, "chain"), values)
    assert made["staging"].dtypes and same(made["staging"], x001.staged)
    assert same(made["signals"], x001.signals)
    assert same(made["features"], x001.features)
    assert same(made["scores"], delay_risk_scores(x001.features, x001.run_ts))
    assert dict(made["features"].dtypes) == dict(x001.features.dtypes)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("template_")]


def test_values_can_be_overridden(spark, x001):
    values = chain_values(x001.as_of, x001.run_ts, x001.run_id) | {"high": 0.0}
    scores = run_chain(spark, x001.raw, x001.po, shared_dir(spark, "chain"), values)["scores"]
    assert {r.risk_level for r in scores.collect()} == {"HIGH"}


HOSTILE = "x' OR 1=1; DROP TABLE t --"


def test_a_hostile_value_stays_a_value(spark):
    spark.createDataFrame([(1, "a"), (2, HOSTILE)], "id int, v string").createOrReplaceTempView("guarded")
    t = Templates(texts={"pick": "SELECT id, :v AS given FROM IDENTIFIER(:t) WHERE v = :v -- :ignored"})
    got = t.run(spark, "pick", {"t": "guarded", "unused": "none"}, {"v": HOSTILE, "more": 1}).collect()
    assert [(r.id, r.given) for r in got] == [(2, HOSTILE)]
    with pytest.raises(PySparkException):
        t.run(spark, "pick", {"t": "guarded WHERE 1=1"}, {"v": "a"}).collect()
    assert spark.table("guarded").count() == 2


def test_names_places_and_missing_parameters(spark, tmp_path):
    assert {"staging_inventory", "demand_signals", "sku_risk_features", "delay_risk_scores"} <= set(Templates().names())
    (tmp_path / "delay_risk_scores.sql").write_text("SELECT 'mine' AS sku_id FROM IDENTIFIER(:features)")
    spark.range(1).createOrReplaceTempView("one")
    own = Templates([str(tmp_path)])
    assert own.run(spark, "delay_risk_scores", {"features": "one"}).first().sku_id == "mine"
    assert own.parameters("delay_risk_scores") == ({"features"}, set())
    assert Templates().parameters("staging_inventory") == ({"raw"}, {"as_of", "run_ts", "run_id"})
    with pytest.raises(ValueError, match="run_id"):
        Templates().run(spark, "staging_inventory", {"raw": "one"}, {"as_of": dt.date(2001, 1, 1), "run_ts": "2001-01-01"})
    for name in ("none", "../sql/staging_inventory"):
        with pytest.raises(UnknownTemplate):
            Templates().text(name)


def test_dispositions_of_a_destination(spark):
    spark.range(3).createOrReplaceTempView("three")
    path, t = shared_dir(spark, "template"), Templates(texts={"all": "SELECT * FROM IDENTIFIER(:t)"})
    assert t.run(spark, "all", {"t": "three"}, destination=path).count() == 3
    assert t.run(spark, "all", {"t": "three"}, destination=path, disposition="WRITE_APPEND").count() == 6
    with pytest.raises(ValueError):
        t.run(spark, "all", {"t": "three"}, destination=path, disposition="WRITE_EMPTY")
