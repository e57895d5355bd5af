"""Raw -> staging: typing, normalisation, quality filter, dedup, lineage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import normalise_text, round_cast_long, signed_quantity

SCHEMA_VERSION = "v1.0"
Dedup = Callable[[DataFrame, str, Sequence[Column]], DataFrame]

STAGED_COLUMNS = (
    "transaction_id", "sku_id", "vendor_id", "warehouse_id", "quantity", "transaction_type",
    "unit_cost", "transaction_timestamp", "transaction_date", "signed_quantity",
    "source_system", "source_file", "ingestion_date", "processed_at", "pipeline_run_id",
    "schema_version",
)


def _ts_lit(ts: dt.datetime) -> Column:
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def dedup_latest(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (ROW_NUMBER ... = 1).

    Catalyst plans the ``row_number() = 1`` filter as a partial
    WindowGroupLimit before the shuffle, so a hot key is cut to one row per
    input partition before it moves; no key ever lands whole in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


# Rows that a task of a sized dedup sorts; keys followed while looking for hot ones.
ROWS_PER_TASK = 250_000
FOLLOWED_KEYS = 10_000


def dedup_sized(df: DataFrame, key: str, order: Sequence[Column], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``dedup_latest`` for large tables: as many tasks as the rows ask for, and no sort before the shuffle.

    The partial limit of the plain plan sorts whole scan tasks, which spill
    when those are large. Here one pass over the key column counts the rows
    and finds keys with more rows than a task should hold (a heavy-hitter
    sketch; it decides where rows go, never which stay). Those few keys take
    the plain plan, which cuts them before they move.
    """
    top = F.expr(f"approx_top_k(`{key}`, 100, {FOLLOWED_KEYS})")
    found = df.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    if found.n <= rows_per_task:
        return dedup_latest(df, key, order)
    hot = [t["item"] for t in found.top or [] if t["count"] > rows_per_task]
    tasks = -(-found.n // rows_per_task)
    if not hot:
        return dedup_latest(df.repartition(tasks, key), key, order)
    is_hot = F.coalesce(F.col(f"`{key}`").isin(hot), F.lit(False))
    return dedup_latest(df.where(~is_hot).repartition(tasks, key), key, order).unionByName(
        dedup_latest(df.where(is_hot), key, order))


def _timestamp() -> Column:
    """Typed transaction timestamp; text that is none becomes NULL (and the row a reject)."""
    return F.col("transaction_timestamp").try_cast("timestamp_ntz")


def staging_rejects(raw: DataFrame) -> DataFrame:
    """The raw rows that staging leaves out, as they came, with ``reject_reasons`` joined by ';'.

    Staged rows before the dedup and rejects together are all raw rows.
    """
    qty = round_cast_long("quantity")
    reasons = F.concat_ws(
        ";", *[F.when(F.col(c).isNull(), F.lit(f"missing:{c}"))
               for c in ("transaction_id", "sku_id", "quantity", "transaction_timestamp")],
        F.when(F.col("quantity").isNotNull() & qty.isNull(), F.lit("bad_quantity")),
        F.when(qty == 0, F.lit("zero_quantity")),
        F.when(F.col("transaction_timestamp").isNotNull() & _timestamp().isNull(), F.lit("bad_timestamp")))
    return raw.withColumn("reject_reasons", reasons).where(F.col("reject_reasons") != "")


def stage_inventory(raw: DataFrame, as_of: dt.date, run_ts: dt.datetime, run_id: str,
                    tie_keys: Sequence[str] = (), dedup: Dedup = dedup_latest) -> DataFrame:
    """Typed, filtered, deduplicated inventory transactions with lineage columns."""
    qty = round_cast_long("quantity")
    typed = raw.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("sku_id").cast("string").alias("sku_id"),
        F.col("vendor_id").cast("string").alias("vendor_id"),
        F.col("warehouse_id").cast("string").alias("warehouse_id"),
        qty.alias("quantity"),
        normalise_text("transaction_type").alias("transaction_type"),
        F.col("unit_cost").try_cast("double").alias("unit_cost"),
        _timestamp().alias("transaction_timestamp"),
        F.col("source_system").cast("string").alias("source_system"),
        F.col("source_file").cast("string").alias("source_file"),
        *[F.col(k) for k in tie_keys],
    )
    # Quality filter first, as the SQL does (WHERE before QUALIFY).
    good = typed.where(
        F.col("transaction_id").isNotNull() & F.col("sku_id").isNotNull()
        & F.col("transaction_timestamp").isNotNull() & F.col("quantity").isNotNull()
        & (F.col("quantity") != 0))
    order = [F.col("transaction_timestamp").desc()] + [F.col(k).desc() for k in tie_keys]
    deduped = dedup(good, "transaction_id", order)
    # What follows from other columns is computed after the dedup, which then moves less.
    full = deduped.withColumns({"transaction_date": F.col("transaction_timestamp").cast("date"),
                                "signed_quantity": signed_quantity("transaction_type", F.col("quantity"))})
    return full.select(
        *[c for c in STAGED_COLUMNS[:12]],
        F.lit(as_of).alias("ingestion_date"),
        _ts_lit(run_ts).alias("processed_at"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def po_order(tie_keys: Sequence[str] = ()) -> list[Column]:
    """Newest version of a purchase order first: the latest receipt, an open one last."""
    return ([F.col("receipt_date").desc_nulls_last()] + [F.col(k).desc() for k in tie_keys]
            + [F.col("vendor_id").asc(), F.col("sku_id").asc(), F.col("expected_date").asc()])


def po_layer_rows(raw_po: DataFrame) -> DataFrame:
    """Staged purchase orders as the layer stores them, all versions: with the month they are partitioned by."""
    every = stage_purchase_order_receipts(raw_po, dedup=lambda df, key, order: df)
    return every.withColumn("po_month", F.trunc("po_date", "month"))


def po_derived() -> dict[str, Column]:
    """The columns of a staged purchase order that follow from its dates."""
    return {"receipt_timestamp": F.col("receipt_date").cast("timestamp_ntz"),
            "lead_days": F.datediff("receipt_date", "po_date").cast("long"),
            "receipt_before_po": F.col("receipt_date") < F.col("po_date")}


def po_layer_derived() -> dict[str, Column]:
    """The same and the month: the columns of the layer that needn't move with a row."""
    return {**po_derived(), "po_month": F.trunc("po_date", "month")}


def stage_purchase_order_receipts(raw_po: DataFrame, tie_keys: Sequence[str] = (),
                                  dedup: Dedup = dedup_latest) -> DataFrame:
    """Typed, deduplicated PO receipts; flags receipts dated before the PO."""
    typed = raw_po.select(
        F.col("po_id").cast("string").alias("po_id"),
        F.col("vendor_id").cast("string").alias("vendor_id"),
        F.col("sku_id").cast("string").alias("sku_id"),
        F.col("po_date").try_cast("date").alias("po_date"),
        F.col("expected_date").try_cast("date").alias("expected_date"),
        F.col("receipt_date").try_cast("date").alias("receipt_date"),
        (F.col("order_key") if "order_key" in raw_po.columns else F.lit(None)).cast("long").alias("order_key"),
        *[F.col(k) for k in tie_keys],
    ).where(F.col("po_id").isNotNull() & F.col("po_date").isNotNull())
    deduped = dedup(typed, "po_id", po_order(tie_keys))
    return deduped.select(
        "po_id", "vendor_id", "sku_id", "po_date", "expected_date", "receipt_date",
        *[c.alias(name) for name, c in po_derived().items()], "order_key",
    )


def enrich_metadata(df: DataFrame, run_id: str, run_ts: dt.datetime,
                    source_system: str = "sage100") -> DataFrame:
    """Lineage columns; keeps a row's own source_system when present."""
    src = (F.coalesce(F.col("source_system").cast("string"), F.lit(source_system))
           if "source_system" in df.columns else F.lit(source_system))
    return df.withColumns({
        "ingestion_date": F.to_date(_ts_lit(run_ts)),
        "pipeline_run_id": F.lit(run_id),
        "_ingested_at": _ts_lit(run_ts),
        "source_system": src,
    })


REQUIRED_FIELDS = ("transaction_id", "sku_id", "quantity", "transaction_type")


def rejection_reasons(required: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """'missing:<col>' for each NULL required column, joined by ';' ('' = valid)."""
    parts = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required]
    return F.concat_ws(";", *parts)


def split_valid(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a reasons column); nothing is dropped silently."""
    tagged = df.withColumn("reject_reasons", rejection_reasons(required))
    valid = tagged.where(F.col("reject_reasons") == "").drop("reject_reasons")
    rejected = tagged.where(F.col("reject_reasons") != "")
    return valid, rejected


def tag_validity(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """One output with an is_valid column (for a single-pass report)."""
    r = rejection_reasons(required)
    return df.withColumn("reject_reasons", r).withColumn("is_valid", F.col("reject_reasons") == "")
