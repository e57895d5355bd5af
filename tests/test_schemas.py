"""Operator outputs conform to the declared table schemas."""

from riskloom import schemas as S
from riskloom.operators.scoring import delay_risk_scores
from riskloom.operators.staging import stage_purchase_order_receipts
from riskloom.streaming import events as ev


def test_layer_outputs_match_declared(x001):
    pairs = [(x001.staged, S.STAGED_INVENTORY), (x001.signals, S.DEMAND_SIGNALS),
             (x001.features, S.SKU_RISK_FEATURES), (delay_risk_scores(x001.features, x001.run_ts), S.DELAY_RISK_SCORES),
             (stage_purchase_order_receipts(x001.raw_po), S.PO_RECEIPTS),
             (ev.parse_envelope(x001.messages), S.EVENT_ENVELOPE),
             (ev.ingest_events(x001.messages, x001.run_id, x001.run_ts).select(*ev.INGEST_COLUMNS), S.INGESTED_EVENTS)]
    for df, schema in pairs:
        assert S.same_columns(df.schema, schema), (df.columns, schema.simpleString())


def test_raw_fixture_covers_declared_raw(x001):
    raw = x001.raw.select(*S.RAW_INVENTORY.fieldNames())
    assert S.same_columns(raw.schema, S.RAW_INVENTORY)
