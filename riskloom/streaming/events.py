"""Event envelopes: decode, validate, route, parse to inventory rows, dead letters.

Every function is a DataFrame -> DataFrame transform with built-in
expressions only, so the same code runs on ``read`` and ``readStream``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.operators.staging import REQUIRED_FIELDS
from riskloom.sources.fixtures import run_ts_lit

# Topics, their event types and target tables.
TOPIC_CONFIG: dict[str, dict] = {
    "erp-transactions": {"event_types": ["po_created", "po_received", "invoice_posted"],
                         "table": "raw.erp_transactions_events"},
    "inventory-events": {"event_types": ["pick", "putaway", "cycle_count", "adjustment"],
                         "table": "raw.inventory_events"},
    "order-events": {"event_types": ["order_placed", "order_shipped", "order_delayed", "order_cancelled"],
                     "table": "raw.order_events"},
}
MAX_DELIVERY_ATTEMPTS = 5
UNKNOWN = "unknown"


def _topic_types_map(config: Mapping[str, dict]) -> Column:
    return F.create_map(*[x for t, c in config.items()
                          for x in (F.lit(t), F.array(*[F.lit(e) for e in c["event_types"]]))])


def _attr(name: str) -> Column:
    return F.col("attributes").getItem(name)


# The decoded payload, carried between steps so that a message is parsed once.
DOC = "__doc"


def _field(doc: Column, name: str) -> Column:
    """A top-level field of a decoded payload as text; NULL where it has none."""
    return F.try_variant_get(doc, f"$.{name}", "string")


def parse_envelope(messages: DataFrame, keep_doc: bool = False) -> DataFrame:
    """Decode the payload; fall back to {"raw_data": text} when it is not JSON.

    event_type = attributes.event_type, else payload.event_type, else 'unknown'.
    ``keep_doc`` leaves the decoded payload (a VARIANT) in the rows, for
    ``parse_inventory_events`` to read its fields from.
    """
    text = F.col("data").cast("string")
    decoded = messages.withColumn(DOC, F.try_parse_json(text))
    doc = F.col(DOC)
    valid = doc.isNotNull()
    payload = F.when(valid, text).otherwise(F.to_json(F.struct(text.alias("raw_data"))))
    et = F.coalesce(F.nullif(_attr("event_type"), F.lit("")), F.nullif(_field(doc, "event_type"), F.lit("")), F.lit(UNKNOWN))
    return decoded.select(
        "message_id", "topic", et.alias("event_type"), payload.alias("payload"),
        "publish_time", F.col("delivery_attempt").cast("int").alias("delivery_attempt"),
        valid.alias("payload_is_json"), *([DOC] if keep_doc else []))


def validate_events(envelopes: DataFrame, config: Mapping[str, dict] = TOPIC_CONFIG) -> DataFrame:
    """errors: missing type, empty payload (-> invalid); warning: type not expected for topic."""
    et = F.col("event_type")
    empty = F.col("payload").isNull() | F.col("payload").rlike(r'^\s*(\{\s*\}|\[\s*\]|null|"")?\s*$')
    errors = F.concat_ws(";", F.when(et == UNKNOWN, F.lit("missing_event_type")),
                         F.when(empty, F.lit("empty_payload")))
    allowed = _topic_types_map(config)[F.col("topic")]
    warn = F.when(allowed.isNotNull() & (et != UNKNOWN) & ~F.array_contains(allowed, et),
                  F.lit("unexpected_event_type"))
    return envelopes.withColumns({"errors": errors, "is_valid": errors == "", "warning": warn})


def dead_letter_split(validated: DataFrame, max_attempts: int = MAX_DELIVERY_ATTEMPTS) -> DataFrame:
    """status: ok (valid) / retry (invalid, attempts left) / dead_letter (invalid, attempts used)."""
    status = (F.when(F.col("is_valid"), F.lit("ok"))
              .when(F.col("delivery_attempt") >= max_attempts, F.lit("dead_letter"))
              .otherwise(F.lit("retry")))
    return validated.withColumn("status", status)


def route_events(envelopes: DataFrame, config: Mapping[str, dict] = TOPIC_CONFIG) -> DataFrame:
    """Target table per topic (unknown topics -> NULL); the routing table is config-sized."""
    tmap = F.create_map(*[x for t, c in config.items() for x in (F.lit(t), F.lit(c["table"]))])
    return envelopes.withColumn("target_table", tmap[F.col("topic")])


def parse_inventory_events(envelopes: DataFrame, run_ts: dt.datetime,
                           type_map: Mapping[str, str] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Payload JSON -> inventory transaction rows with parse status and reasons.

    transaction_id = payload.transaction_id or payload.id; transaction_type
    = payload.event_type or payload.transaction_type; quantity truncated to
    an integer (blank = missing). Timestamp: payload.timestamp, else the
    message publish time. Rows that cannot be used are kept with reasons
    (dead-letter output), never raised. ``carry``: envelope columns to keep.
    The decoded payload of ``parse_envelope(keep_doc=True)`` is used if it
    is there, else the payload text is parsed here, once.
    """
    if DOC not in envelopes.columns:
        envelopes = envelopes.withColumn(DOC, F.try_parse_json("payload"))
    fields = {"j_tid": "transaction_id", "j_id": "id", "j_sku": "sku_id", "j_vendor": "vendor_id", "j_qty": "quantity",
              "j_event_type": "event_type", "j_ttype": "transaction_type", "j_ts": "timestamp"}
    # All fields as one generated row: filters on the result stay above it, so they don't repeat the parse.
    parsed = envelopes.select("*", F.inline(F.array(F.struct(*[_field(F.col(DOC), name).alias(c) for c, name in fields.items()]))))

    def blank_null(c: str) -> Column:
        return F.nullif(F.trim(F.col(c)), F.lit(""))

    number = blank_null("j_qty").try_cast("double")
    # Not a number, infinite or beyond a long: no quantity, so the row is rejected with a reason.
    qty_d = F.when(~F.isnan(number) & (F.abs(number) < F.lit(float(2**63))), number)
    ttype = F.coalesce(blank_null("j_event_type"), blank_null("j_ttype"))
    if type_map:
        m = F.create_map(*[x for k, v in type_map.items() for x in (F.lit(k), F.lit(v))])
        ttype = F.coalesce(m[ttype], ttype)
    # With an offset: converted to the session's clock (UTC); without: taken as it is.
    own_ts = blank_null("j_ts").try_cast("timestamp").cast("timestamp_ntz")
    ts = F.coalesce(own_ts, F.col("publish_time").cast("timestamp_ntz"))
    rows = parsed.select(
        "message_id", "topic", *carry,
        F.coalesce(blank_null("j_tid"), blank_null("j_id")).alias("transaction_id"),
        blank_null("j_sku").alias("sku_id"),
        blank_null("j_vendor").alias("vendor_id"),
        F.when(qty_d.isNotNull(), F.when(qty_d >= 0, F.floor(qty_d)).otherwise(F.ceil(qty_d)))
        .cast("long").alias("quantity"),
        ttype.alias("transaction_type"),
        ts.alias("transaction_timestamp"),
        F.col("payload_is_json"),
        blank_null("j_qty").alias("__qty_text"),
        (blank_null("j_ts").isNotNull() & own_ts.isNull()).alias("__bad_ts"),
    )
    reasons = F.concat_ws(";", F.when(~F.col("payload_is_json"), F.lit("unparseable_payload")),
                          F.when(F.col("__qty_text").isNotNull() & F.col("quantity").isNull(),
                                 F.lit("bad_quantity")),
                          F.when(F.col("__bad_ts"), F.lit("bad_timestamp")),
                          *[F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in REQUIRED_FIELDS])
    return (rows.withColumn("reject_reasons", reasons)
            .withColumn("is_valid", F.col("reject_reasons") == "")
            .drop("__qty_text", "__bad_ts", "payload_is_json"))


def enrich_stream_rows(rows: DataFrame, run_id: str, run_ts: dt.datetime, source_system: str = "sage100") -> DataFrame:
    """Lineage columns for ingested event rows (same as the batch enrich step)."""
    return rows.withColumns({
        "source_system": F.lit(source_system),
        "ingestion_date": F.to_date(run_ts_lit(run_ts)),
        "pipeline_run_id": F.lit(run_id),
        "_ingested_at": run_ts_lit(run_ts),
    })


def ingest_events(messages: DataFrame, run_id: str, run_ts: dt.datetime) -> DataFrame:
    """parse envelope -> parse inventory payload -> validate -> enrich (batch or stream)."""
    env = parse_envelope(messages, keep_doc=True)
    rows = parse_inventory_events(env, run_ts)
    return enrich_stream_rows(rows, run_id, run_ts)


def ingest_outcomes(messages: DataFrame, run_id: str, run_ts: dt.datetime,
                    max_attempts: int = MAX_DELIVERY_ATTEMPTS) -> DataFrame:
    """Ingested rows with ``status``: ok, retry (rejected, attempts left) or dead_letter (rejected, attempts used)."""
    env = parse_envelope(messages, keep_doc=True)
    rows = enrich_stream_rows(parse_inventory_events(env, run_ts, carry=("delivery_attempt",)), run_id, run_ts)
    return dead_letter_split(rows, max_attempts)


INGEST_COLUMNS = ("message_id", "topic", "transaction_id", "sku_id", "vendor_id", "quantity",
                  "transaction_type", "transaction_timestamp", "reject_reasons", "is_valid",
                  "source_system", "ingestion_date", "pipeline_run_id", "_ingested_at")


# Columns of a message that a row handler is given.
MESSAGE = ("message_id", "topic", "event_type", "payload", "publish_time", "delivery_attempt")


def row_handler(fn: Callable[[dict], bool], columns: Sequence[str] = MESSAGE) -> Callable[[DataFrame], Column]:
    """A handler for ``consume`` from a Python function of one message (a dict) that says whether it succeeded.

    It runs on Arrow batches, for valid messages only. What it raises stays
    with its row, as the error text; the batch goes on.
    """
    @F.pandas_udf("ok boolean, error string")
    def run(valid: pd.Series, messages: pd.DataFrame) -> pd.DataFrame:
        ok, errors = [], []
        for is_valid, message in zip(valid, messages.to_dict("records")):
            result, error = None, None
            if is_valid:
                try:
                    result = bool(fn(message))
                except Exception as e:  # the handler is the user's: whatever it raises
                    error = f"{type(e).__name__}: {e}"
            ok.append(result)
            errors.append(error)
        return pd.DataFrame({"ok": pd.array(ok, dtype="boolean"), "error": errors})

    return lambda v: run(F.col("is_valid"), F.struct(*columns))


def consume(messages: DataFrame, handler: Callable[[DataFrame], Column],
            max_attempts: int = MAX_DELIVERY_ATTEMPTS) -> DataFrame:
    """Per message status: invalid / failed (handler false, NULL or raising) / processed, plus error and retry flag.

    ``handler`` maps the validated envelopes to a boolean Column (a built-in
    expression or a pandas UDF), or to a struct of ok and error, as
    ``row_handler`` makes from a Python function.
    """
    v = validate_events(parse_envelope(messages))
    handled = v.withColumn("__handled", handler(v))
    if isinstance(handled.schema["__handled"].dataType, StructType):
        ok, error = F.col("__handled.ok"), F.col("__handled.error")
    else:
        ok, error = F.col("__handled"), F.lit(None).cast("string")
    status = (F.when(~F.col("is_valid"), F.lit("invalid"))
              .when(F.coalesce(ok, F.lit(False)), F.lit("processed"))
              .otherwise(F.lit("failed")))
    return handled.withColumn("status", status).withColumn("error", F.when(F.col("status") == "failed", error)).withColumn(
        "nack_for_retry", (F.col("status") != "processed") & (F.col("delivery_attempt") < max_attempts)).drop("__handled")


def consume_stats(statuses: DataFrame) -> DataFrame:
    """Counters (processed, failed, invalid) from the per-message statuses."""
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n_messages"))


def consume_summary(counters: DataFrame) -> DataFrame:
    """One row for a run: processed, failed, invalid, those of the failed that raised, and micro-batches."""
    def of(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n_messages"))), F.lit(0)).cast("long").alias(status)
    return counters.agg(of("processed"), of("failed"), of("invalid"),
                        F.coalesce(F.sum("n_raised"), F.lit(0)).cast("long").alias("raised"),
                        F.count_distinct("batch_id").alias("batches"))


def dlq_replay(dead: DataFrame, loaded: DataFrame, fix: Callable[[DataFrame], DataFrame],
               run_id: str, run_ts: dt.datetime) -> DataFrame:
    """Re-run parse + validate over fixed dead letters; keep survivors not already loaded."""
    fixed = fix(dead)
    rows = enrich_stream_rows(parse_inventory_events(fixed, run_ts), run_id, run_ts)
    good = rows.where(F.col("is_valid"))
    return good.join(loaded.select("transaction_id").distinct(), "transaction_id", "left_anti")


def backlog_depth(messages: DataFrame, processed: DataFrame, limit: int = 10_000) -> DataFrame:
    """Unprocessed messages per topic and an alert flag above ``limit``."""
    pending = messages.join(processed.select("message_id").distinct(), "message_id", "left_anti")
    return (pending.groupBy("topic").agg(F.count(F.lit(1)).alias("backlog"))
            .withColumn("alert", F.col("backlog") > F.lit(limit)))


def default_type_fix(topic_defaults: Mapping[str, str]) -> Callable[[DataFrame], DataFrame]:
    """A dead-letter fix: fill a missing event type with the topic's default type."""
    m = F.create_map(*[x for k, v in topic_defaults.items() for x in (F.lit(k), F.lit(v))])

    def fix(df: DataFrame) -> DataFrame:
        et = F.when(F.col("event_type") == UNKNOWN, m[F.col("topic")]).otherwise(F.col("event_type"))
        payload = F.when(
            F.col("payload_is_json") & F.get_json_object("payload", "$.event_type").isNull() & et.isNotNull(),
            F.regexp_replace("payload", r"\}\s*$", F.concat(F.lit(',"event_type":"'), et, F.lit('"}'))))
        return df.withColumn("payload", F.coalesce(payload, F.col("payload"))).withColumn("event_type", et)
    return fix

