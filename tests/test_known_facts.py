"""Facts stated in FIXTURES.md (computed there independently in DuckDB)."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions.columns import supply_risk_branch
from riskloom.operators.leadtime import vendor_lead_times
from riskloom.operators.scoring import delay_risk_scores

FACTS = {
    # sf: (raw, staged, skus, stockout skus, lead groups, branches 1/2/3/none, HIGH/MEDIUM/LOW)
    "x001": (6000, 4462, 49, 37, 154, (2, 3, 44, 0), (0, 13, 36)),
    "x01": (60000, 44799, 50, 44, 483, (1, 9, 36, 4), (3, 42, 5)),
}


@pytest.mark.parametrize("fx_name", ["x001", "x01"])
def test_chain_facts(request, fx_name):
    x = request.getfixturevalue(fx_name)
    raw, staged, skus, stockout, groups, branches, bands = FACTS[fx_name]
    assert x.raw.count() == raw
    assert x.staged.count() == staged
    sig = x.signals
    assert sig.count() == skus
    assert sig.where(F.col("stockout_flag") == 1).count() == stockout
    assert vendor_lead_times(x.po, x.as_of).count() == groups
    f = x.features
    got = {r[0]: r[1] for r in f.groupBy(supply_risk_branch().alias("b")).count().collect()}
    assert tuple(got.get(i, 0) for i in (1, 2, 3, 0)) == branches
    lv = {r[0]: r[1] for r in delay_risk_scores(f, x.run_ts).groupBy("risk_level").count().collect()}
    assert tuple(lv.get(k, 0) for k in ("HIGH", "MEDIUM", "LOW")) == bands


def test_raw_nulls_sf001_sf01(x01):
    r = x01.raw.agg(F.count_if(F.col("sku_id").isNull()), F.count_if(F.col("vendor_id").isNull()),
                    F.count_if(F.col("quantity") == 0)).first()
    assert tuple(r) == (646, 3634, 1175)


def test_event_facts_sf01(x01):
    from riskloom.streaming import events as ev
    env = ev.validate_events(ev.parse_envelope(x01.messages))
    r = env.agg(F.count(F.lit(1)), F.count_if(~F.col("payload_is_json")), F.count_if(~F.col("is_valid")),
                F.count_if(F.col("delivery_attempt") >= 5),
                F.count_if((F.col("warning") == "unexpected_event_type")
                           & (F.col("event_type") == "price_changed"))).first()
    assert tuple(r) == (10000, 1010, 1501, 2856, 692)
