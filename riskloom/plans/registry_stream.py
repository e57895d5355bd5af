"""Registered queries: event envelopes and Structured Streaming operators.

Streaming keys run a real ``readStream`` over the events file with an
``availableNow`` trigger into a Parquet sink in the shared checkpoint
folder, then return the sink read back as a batch DataFrame.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.leadtime import sku_vendor_map
from riskloom.plans.context import Inputs
from riskloom.plans.oracle import RUN_ID, RUN_TS, oracle
from riskloom.plans.registry import query
from riskloom.schemas import EVENTS_SOURCE
from riskloom.session import shared_dir
from riskloom.sources import fixtures as fx
from riskloom.streaming import events as ev
from riskloom.streaming import runner as rn
from riskloom.streaming.dedup import run_dedup

EVENTS_SCHEMA = EVENTS_SOURCE
# A dead-letter fix fills a missing type with the topic's first type.
TOPIC_DEFAULT_TYPE = {t: c["event_types"][0] for t, c in ev.TOPIC_CONFIG.items()}


def _stream_messages(x: Inputs) -> DataFrame:
    src = rn.read_events_stream(x.spark, x.sf_dir, EVENTS_SCHEMA, glob="events.parquet")
    return fx.event_messages(src)


def _handler(v: DataFrame):
    """Example consumer handler: accepts messages whose payload quantity is positive."""
    return F.get_json_object("payload", "$.quantity").try_cast("double") > 0


# Shared oracle CTEs: envelope, validation, parse (DuckDB JSON functions).
_ENV = """, env AS (
  SELECT message_id, topic, delivery_attempt, publish_time, json_valid(data) AS payload_is_json,
    CASE WHEN json_valid(data) THEN data ELSE '{"raw_data":' || to_json(data) || '}' END AS payload,
    COALESCE(NULLIF(attr_event_type, ''), NULLIF(CASE WHEN json_valid(data) THEN json_extract_string(data, '$.event_type') END, ''),
             'unknown') AS event_type
  FROM event_messages),
val AS (
  SELECT *, concat_ws(';', CASE WHEN event_type = 'unknown' THEN 'missing_event_type' END,
      CASE WHEN payload IS NULL OR regexp_matches(payload, '^\\s*\\{\\s*\\}\\s*$') THEN 'empty_payload' END) AS errors,
    CASE WHEN event_type <> 'unknown' AND topic IN ('erp-transactions', 'inventory-events', 'order-events')
      AND NOT list_contains(CASE topic WHEN 'erp-transactions' THEN ['po_created', 'po_received', 'invoice_posted']
                                       WHEN 'inventory-events' THEN ['pick', 'putaway', 'cycle_count', 'adjustment']
                                       ELSE ['order_placed', 'order_shipped', 'order_delayed', 'order_cancelled'] END, event_type)
      THEN 'unexpected_event_type' END AS warning
  FROM env),
val2 AS (SELECT *, errors = '' AS is_valid,
    CASE WHEN errors = '' THEN 'ok' WHEN delivery_attempt >= 5 THEN 'dead_letter' ELSE 'retry' END AS status FROM val),
js AS (
  SELECT message_id, topic, publish_time, payload_is_json,
    NULLIF(trim(json_extract_string(payload, '$.transaction_id')), '') AS j_tid,
    NULLIF(trim(json_extract_string(payload, '$.id')), '') AS j_id,
    NULLIF(trim(json_extract_string(payload, '$.sku_id')), '') AS j_sku,
    NULLIF(trim(json_extract_string(payload, '$.vendor_id')), '') AS j_vendor,
    NULLIF(trim(json_extract_string(payload, '$.quantity')), '') AS j_qty,
    COALESCE(NULLIF(trim(json_extract_string(payload, '$.event_type')), ''),
             NULLIF(trim(json_extract_string(payload, '$.transaction_type')), '')) AS j_type
  FROM env),
parsed AS (
  SELECT message_id, topic, COALESCE(j_tid, j_id) AS transaction_id, j_sku AS sku_id, j_vendor AS vendor_id,
    CAST(trunc(TRY_CAST(j_qty AS DOUBLE)) AS BIGINT) AS quantity, j_type AS transaction_type,
    publish_time AS transaction_timestamp,
    concat_ws(';', CASE WHEN NOT payload_is_json THEN 'unparseable_payload' END,
      CASE WHEN j_qty IS NOT NULL AND TRY_CAST(j_qty AS DOUBLE) IS NULL THEN 'bad_quantity' END,
      CASE WHEN COALESCE(j_tid, j_id) IS NULL THEN 'missing:transaction_id' END,
      CASE WHEN j_sku IS NULL THEN 'missing:sku_id' END,
      CASE WHEN TRY_CAST(j_qty AS DOUBLE) IS NULL THEN 'missing:quantity' END,
      CASE WHEN j_type IS NULL THEN 'missing:transaction_type' END) AS reject_reasons
  FROM js),
ingested AS (
  SELECT *, reject_reasons = '' AS is_valid, 'sage100' AS source_system, CAST(""" + RUN_TS + """ AS DATE) AS ingestion_date,
    """ + RUN_ID + """ AS pipeline_run_id, """ + RUN_TS + """ AS _ingested_at FROM parsed)"""


def stream_oracle(key: str, body: str) -> None:
    oracle(key, _ENV + "\n" + body)


@query("parse_envelope")
def _parse_envelope(x: Inputs) -> DataFrame:
    return ev.parse_envelope(x.messages)


stream_oracle("parse_envelope", """SELECT message_id, topic, event_type, payload, publish_time, delivery_attempt,
  payload_is_json FROM env""")


@query("validate_events")
def _validate_events(x: Inputs) -> DataFrame:
    return ev.validate_events(ev.parse_envelope(x.messages)).select(
        "message_id", "topic", "event_type", "errors", "is_valid", "warning")


stream_oracle("validate_events", "SELECT message_id, topic, event_type, errors, errors = '' AS is_valid, warning FROM val")


@query("route_events")
def _route_events(x: Inputs) -> DataFrame:
    return ev.route_events(ev.parse_envelope(x.messages)).select("message_id", "topic", "event_type", "target_table")


stream_oracle("route_events", """SELECT message_id, topic, event_type,
  CASE topic WHEN 'erp-transactions' THEN 'raw.erp_transactions_events' WHEN 'inventory-events' THEN 'raw.inventory_events'
             WHEN 'order-events' THEN 'raw.order_events' END AS target_table FROM env""")


@query("parse_inventory_events")
def _parse_inventory(x: Inputs) -> DataFrame:
    return ev.parse_inventory_events(ev.parse_envelope(x.messages), x.run_ts)


stream_oracle("parse_inventory_events", "SELECT *, reject_reasons = '' AS is_valid FROM parsed")


@query("dead_letter_split")
def _dead_letter(x: Inputs) -> DataFrame:
    v = ev.validate_events(ev.parse_envelope(x.messages))
    return ev.dead_letter_split(v).select("message_id", "topic", "delivery_attempt", "status")


stream_oracle("dead_letter_split", "SELECT message_id, topic, delivery_attempt, status FROM val2")


@query("stream_ingest")
def _stream_ingest(x: Inputs) -> DataFrame:
    """readStream(events) -> parse -> validate -> enrich -> append (availableNow) -> staged rows."""
    rows = ev.ingest_events(_stream_messages(x), x.run_id, x.run_ts).where(F.col("is_valid"))
    return rn.run_to_table(rows.select(*ev.INGEST_COLUMNS), "stream-ingest")


stream_oracle("stream_ingest", "SELECT * FROM ingested WHERE is_valid")


@query("ingest_outcomes")
def _ingest_outcomes(x: Inputs) -> DataFrame:
    """Every ingested message in the table of its outcome: ok, retry or dead_letter."""
    rows = ev.ingest_outcomes(_stream_messages(x), x.run_id, x.run_ts)
    return rn.run_outcomes(rows, "ingest-outcomes").select("message_id", "status", "transaction_id", "reject_reasons")


stream_oracle("ingest_outcomes", """SELECT message_id, CASE WHEN is_valid THEN 'ok' WHEN delivery_attempt >= 5 THEN 'dead_letter'
  ELSE 'retry' END AS status, transaction_id, reject_reasons
FROM ingested JOIN (SELECT message_id, delivery_attempt FROM event_messages) m USING (message_id)""")


@query("batch_stream_parity")
def _parity(x: Inputs) -> DataFrame:
    """Same transform on read and readStream: counts and rows that differ (0 expected)."""
    batch = ev.ingest_events(x.messages, x.run_id, x.run_ts).select(*ev.INGEST_COLUMNS)
    stream = rn.run_to_table(ev.ingest_events(_stream_messages(x), x.run_id, x.run_ts)
                             .select(*ev.INGEST_COLUMNS), "stream-parity")
    diff = batch.exceptAll(stream).unionByName(stream.exceptAll(batch))
    b = batch.agg(F.count(F.lit(1)).alias("n_batch"))
    return b.select("n_batch", stream.agg(F.count(F.lit(1))).scalar().alias("n_stream"),
                    diff.agg(F.count(F.lit(1))).scalar().alias("n_mismatch"))


stream_oracle("batch_stream_parity", "SELECT COUNT(*) AS n_batch, COUNT(*) AS n_stream, CAST(0 AS BIGINT) AS n_mismatch FROM ingested")


@query("consume_stats")
def _consume_stats(x: Inputs) -> DataFrame:
    """Stream consumer with a handler; counters appended per micro-batch, summed at the end."""
    counters = rn.consume_counters(_stream_messages(x), lambda b: ev.consume(b, _handler), "consume")
    return counters.groupBy("status").agg(F.sum("n_messages").cast("long").alias("n_messages"))


stream_oracle("consume_stats", """SELECT CASE WHEN NOT is_valid THEN 'invalid'
    WHEN COALESCE(TRY_CAST(json_extract_string(payload, '$.quantity') AS DOUBLE) > 0, FALSE) THEN 'processed'
    ELSE 'failed' END AS status, COUNT(*) AS n_messages FROM val2 GROUP BY 1""")


# Fixed value: files, and so micro-batches, of the consumer's source.
CONSUMER_BATCHES = 4


def _strict_handler(message: dict) -> bool:
    """Example of a handler in Python: it can't do without a quantity, refuses every seventh one, wants it positive."""
    quantity = json.loads(message["payload"])["quantity"]
    if quantity % 7 == 0:
        raise ValueError("quantity refused")
    return quantity > 0


@query("consume_summary")
def _consume_summary(x: Inputs) -> DataFrame:
    """A Python handler that raises on some rows, over several micro-batches: the counters of the run."""
    path = shared_dir(x.spark, "consumer-source")
    x.table("events").repartitionByRange(CONSUMER_BATCHES, "event_id").write.parquet(path)
    source = rn.read_events_stream(x.spark, path, EVENTS_SCHEMA, max_files_per_trigger=1)
    handler = ev.row_handler(_strict_handler)
    return ev.consume_summary(rn.consume_counters(fx.event_messages(source), lambda b: ev.consume(b, handler), "consume-summary"))


stream_oracle("consume_summary", f""", q AS (SELECT is_valid, TRY_CAST(json_extract_string(payload, '$.quantity') AS BIGINT) AS q FROM val2)
SELECT CAST(count_if(is_valid AND COALESCE(q % 7 <> 0 AND q > 0, FALSE)) AS BIGINT) AS processed,
  CAST(count_if(is_valid AND NOT COALESCE(q % 7 <> 0 AND q > 0, FALSE)) AS BIGINT) AS failed,
  CAST(count_if(NOT is_valid) AS BIGINT) AS invalid,
  CAST(count_if(is_valid AND (q IS NULL OR q % 7 = 0)) AS BIGINT) AS raised, CAST({CONSUMER_BATCHES} AS BIGINT) AS batches FROM q""")


def _complete(df: DataFrame) -> DataFrame:
    """A dead-letter fix: the topic's type, an id from the message and one unit, for payloads that are JSON objects."""
    typed = ev.default_type_fix(TOPIC_DEFAULT_TYPE)(df)
    add = F.concat(F.lit(',"transaction_id":"R-'), F.col("message_id"), F.lit('","quantity":1}'))
    lacks = F.col("payload_is_json") & F.get_json_object("payload", "$.transaction_id").isNull()
    return typed.withColumn("payload", F.when(lacks, F.regexp_replace("payload", F.lit(r"\}\s*$"), add))
                            .otherwise(F.col("payload")))


@query("dlq_replay")
def _dlq_replay(x: Inputs) -> DataFrame:
    """Dead letters of the ingest re-parsed after a fix; the recovered rows that aren't loaded yet."""
    env = ev.parse_envelope(x.messages)
    rows = ev.ingest_outcomes(x.messages, x.run_id, x.run_ts)
    dead = env.join(rows.where(F.col("status") == "dead_letter").select("message_id"), "message_id", "left_semi")
    loaded = rows.where(F.col("status") == "ok")
    found = ev.dlq_replay(dead, loaded, _complete, x.run_id, x.run_ts)
    return found.select("message_id", "transaction_id", "sku_id", "quantity", "transaction_type")


stream_oracle("dlq_replay", f"""SELECT e.message_id, 'R-' || e.message_id AS transaction_id,
  json_extract_string(e.payload, '$.sku_id') AS sku_id, CAST(1 AS BIGINT) AS quantity,
  CASE WHEN e.event_type <> 'unknown' THEN e.event_type ELSE CASE e.topic {' '.join(f"WHEN '{t}' THEN '{d}'" for t, d in TOPIC_DEFAULT_TYPE.items())} END END AS transaction_type
FROM env e JOIN ingested i USING (message_id)
WHERE NOT i.is_valid AND e.delivery_attempt >= 5 AND e.payload_is_json""")


@query("stream_tumbling_1m")
def _tumbling(x: Inputs) -> DataFrame:
    env = ev.parse_envelope(_stream_messages(x))
    return rn.run_to_table(rn.tumbling(env, "publish_time", "1 minute", ("topic",), "10 minutes"), "tumbling")


stream_oracle("stream_tumbling_1m", """, w AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, publish_time) AS window_start, topic FROM env)
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, topic, COUNT(*) AS n_events FROM w
WHERE window_start + INTERVAL 1 MINUTE <= (SELECT MAX(publish_time) FROM env) - INTERVAL 10 MINUTE
GROUP BY window_start, topic""")


@query("stream_dedup")
def _stream_dedup(x: Inputs) -> DataFrame:
    """Redelivered messages dropped: one row per id and task shipped, ids of earlier batches from the store."""
    msgs = fx.with_redeliveries(_stream_messages(x)).select("message_id", "topic", "publish_time", "delivery_attempt")
    return run_dedup(msgs, "dedup", "message_id", "publish_time", 600)


@query("stream_dedup_watermark")
def _stream_dedup_watermark(x: Inputs) -> DataFrame:
    """The same with Spark's own state (``dropDuplicatesWithinWatermark``)."""
    msgs = fx.with_redeliveries(_stream_messages(x))
    out = rn.dedup_stream(msgs, "message_id", "publish_time", "10 minutes")
    return rn.run_to_table(out.select("message_id", "topic", "publish_time", "delivery_attempt"), "dedup")


stream_oracle("stream_dedup_watermark", "SELECT DISTINCT message_id, topic, publish_time, delivery_attempt FROM event_messages")
stream_oracle("stream_dedup", "SELECT DISTINCT message_id, topic, publish_time, delivery_attempt FROM event_messages")


@query("stream_enrich")
def _stream_enrich(x: Inputs) -> DataFrame:
    dim = rn.materialize(sku_vendor_map(x.recent_staged, x.as_of)
                         .select("sku_id", F.col("vendor_id").alias("main_vendor_id")), "dim-sku-vendor")
    rows = ev.ingest_events(_stream_messages(x), x.run_id, x.run_ts).where(F.col("is_valid"))
    out = rn.enrich_reference(rows.select("message_id", "sku_id", "quantity"), dim, "sku_id")
    return rn.run_to_table(out, "enrich")


stream_oracle("stream_enrich", """SELECT i.message_id, i.sku_id, i.quantity, s.vendor_id AS main_vendor_id
FROM ingested i LEFT JOIN svm s ON i.sku_id = s.sku_id WHERE i.is_valid""")


@query("backlog_depth")
def _backlog(x: Inputs) -> DataFrame:
    v = ev.dead_letter_split(ev.validate_events(ev.parse_envelope(x.messages)))
    processed = v.where(F.col("status") == "ok")
    return ev.backlog_depth(x.messages, processed)


stream_oracle("backlog_depth", """SELECT topic, COUNT(*) AS backlog, COUNT(*) > 10000 AS alert FROM val2
WHERE status <> 'ok' GROUP BY topic""")
