"""Registered queries: sources, sinks, landing manifest, quality and governance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import governance as gv
from riskloom.operators import quality as qa
from riskloom.operators import staging as st
from riskloom.operators.scoring import read_latest_snapshot
from riskloom.plans.context import Inputs
from riskloom.plans.oracle import AS_OF, RUN_ID, RUN_TS, oracle
from riskloom.plans.registry import query
from riskloom.session import shared_dir
from riskloom.sources import landing as ld
from riskloom.sources import manifest as mf
from riskloom.sources import sinks as sk
from riskloom.sources import zones as zn
from riskloom.sources.files import list_files
from riskloom.streaming.runner import materialize

RAW_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("sku_id", T.StringType()),
    T.StructField("vendor_id", T.StringType()), T.StructField("warehouse_id", T.StringType()),
    T.StructField("quantity", T.LongType()), T.StructField("transaction_type", T.StringType()),
    T.StructField("unit_cost", T.DoubleType()), T.StructField("transaction_timestamp", T.TimestampNTZType()),
    T.StructField("source_system", T.StringType()), T.StructField("source_file", T.StringType()),
    T.StructField("tie_key", T.DoubleType()),
])
RAW_COLS = ", ".join(f.name for f in RAW_SCHEMA.fields)

# ------------------------------------------------------------------- scans
@query("scan_parquet", exact=("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
def _scan_parquet(x: Inputs) -> DataFrame:
    """Recursive parquet scan of the landing folder, one table picked by glob."""
    return ld.read_landing(x.spark, x.sf_dir, "parquet", glob="lineitem.parquet")


oracle("scan_parquet", "SELECT * FROM lineitem")


def _roundtrip(x: Inputs, fmt: str) -> DataFrame:
    path = shared_dir(x.spark, f"landing-{fmt}")
    raw = x.raw
    if fmt == "csv":
        (raw.write.mode("overwrite").option("header", "true").option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").csv(path))
    else:
        raw.write.mode("overwrite").json(path)
    return ld.read_landing(x.spark, path, fmt, schema=RAW_SCHEMA)


@query("scan_csv_roundtrip", exact=("unit_cost", "tie_key"))
def _scan_csv(x: Inputs) -> DataFrame:
    return _roundtrip(x, "csv")


@query("scan_jsonl_roundtrip", exact=("unit_cost", "tie_key"))
def _scan_jsonl(x: Inputs) -> DataFrame:
    return _roundtrip(x, "jsonl")


oracle("scan_csv_roundtrip", f"SELECT {RAW_COLS} FROM raw_inventory_transactions")
oracle("scan_jsonl_roundtrip", f"SELECT {RAW_COLS} FROM raw_inventory_transactions")


@query("partitioned_write_roundtrip", exact=("unit_cost",))
def _partitioned_write(x: Inputs) -> DataFrame:
    """Staging written partitioned by ingestion_date, clustered by (sku, vendor), read back."""
    path = shared_dir(x.spark, "staging-inventory")
    sk.write_table(x.staged, path, "WRITE_TRUNCATE", partition_by=("ingestion_date",),
                   cluster_by=("sku_id", "vendor_id"))
    back = x.spark.read.parquet(path)
    return back.select(*st.STAGED_COLUMNS)


oracle("partitioned_write_roundtrip", """
SELECT transaction_id, sku_id, vendor_id, warehouse_id, quantity, transaction_type, unit_cost,
  transaction_timestamp, transaction_date, signed_quantity, source_system, source_file, ingestion_date,
  processed_at, pipeline_run_id, schema_version FROM staged""")


@query("partition_filter", exact=("o_totalprice",))
def _partition_filter(x: Inputs) -> DataFrame:
    o = x.table("orders").withColumn("order_date", F.to_date("o_orderdate"))
    return ld.partition_filter(o, "order_date", dt.date(1995, 1, 1), dt.date(1995, 12, 31),
                               ["o_orderkey", "o_custkey", "o_totalprice", "order_date"],
                               "o_orderstatus = 'F'")


oracle("partition_filter", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' AND (o_orderstatus = 'F')""")


# --------------------------------------------------------------- manifest
def _orders_manifest(x: Inputs) -> DataFrame:
    orders = x.table("orders").withColumn("landing_date", F.trunc(F.to_date("o_orderdate"), "month"))
    return mf.planned_entries(orders, "sage100", "landing_date", x.run_id, x.run_ts,
                         filename="orders.parquet")


def _processed_paths(manifest: DataFrame) -> DataFrame:
    """Fixture: months divisible by 3 already have a processed/ copy."""
    return manifest.where(F.month("landing_date") % 3 == 0).select(
        F.regexp_replace("path", "^raw/", "processed/").alias("path"))


def _landed(x: Inputs) -> str:
    """Orders landed by month in a store of their own."""
    root = shared_dir(x.spark, "lake")
    orders = x.table("orders").withColumn("landing_date", F.trunc(F.to_date("o_orderdate"), "month"))
    zn.land(orders, root, "sage100", "landing_date", x.run_id, x.run_ts, filename="orders.parquet")
    return root


def _rows_of(x: Inputs, root: str, zone: str, name: str) -> DataFrame:
    """(path, rows) of a zone, counted in the files that its entries name."""
    rows = zn.read_entries(x.spark, root, zn.current(x.spark, root, zone))
    return rows.groupBy(F.col("entry_path").alias("path")).agg(F.count(F.lit(1)).alias(name))


@query("landing_manifest")
def _landing_manifest(x: Inputs) -> DataFrame:
    """Entries of a landed batch; every named file exists, and together they hold the bytes stated."""
    root = _landed(x)
    m = zn.current(x.spark, root, "raw")
    named = m.select("path", F.explode("files").alias("file"))
    found = list_files(x.spark, root).select(zn.inside(root, F.col("path")).alias("file"), F.col("n_bytes").alias("size"))
    sizes = named.join(found, "file", "left").groupBy("path").agg(
        F.bool_and(F.col("size").isNotNull()).alias("files_exist"), F.sum("size").alias("size"))
    return m.join(sizes, "path").select(*mf.MANIFEST_COLUMNS, "files_exist", (F.col("size") == F.col("n_bytes")).alias("bytes_match"))


_MANIFEST_SQL = f"""
m AS (
  SELECT 'raw/prod/sage100/' || strftime(CAST(date_trunc('month', o_orderdate) AS DATE), '%Y-%m-%d') || '/orders.parquet' AS path,
    'raw' AS zone, 'sage100' AS source_system, CAST(date_trunc('month', o_orderdate) AS DATE) AS landing_date,
    {RUN_TS} AS ingestion_timestamp, 'v1.0' AS schema_version, COUNT(*) AS record_count,
    {RUN_ID} AS pipeline_run_id, 'orders.parquet' AS original_filename,
    'application/octet-stream' AS content_type
  FROM orders GROUP BY date_trunc('month', o_orderdate)),
done AS (SELECT path FROM m WHERE month(landing_date) % 3 <> 0)"""

oracle("landing_manifest", f", {_MANIFEST_SQL}\nSELECT *, TRUE AS files_exist, TRUE AS bytes_match FROM m")


@query("unprocessed_files")
def _unprocessed(x: Inputs) -> DataFrame:
    m = _orders_manifest(x)
    return mf.unprocessed_files(m.select("path"), _processed_paths(m))


oracle("unprocessed_files", f", {_MANIFEST_SQL}\nSELECT path FROM done ORDER BY path")


@query("promote_files")
def _promote(x: Inputs) -> DataFrame:
    """Months not yet processed copied to the processed zone, both zones read back; other zones' paths are rejected.

    Two requests: the months divisible by 3 first, then all paths of either
    zone and one that doesn't exist.
    """
    root = _landed(x)
    third = zn.current(x.spark, root, "raw").where(F.month("landing_date") % 3 == 0)
    zn.promote(x.spark, root, third.select("path"), x.run_ts)
    asked = zn.unprocessed(x.spark, root).unionByName(zn.current(x.spark, root, "processed").select("path")).unionByName(
        x.spark.createDataFrame([("raw/prod/sage100/1900-01-01/orders.parquet",)], "path string"))
    report = materialize(zn.promote(x.spark, root, asked, x.run_ts + dt.timedelta(hours=1)), "promoted")
    return (report.join(_rows_of(x, root, "processed", "processed_rows"), "path", "left")
            .join(_rows_of(x, root, "raw", "raw_rows").withColumnRenamed("path", "source_path"), "source_path", "left")
            .select("source_path", "path", "record_count", "processed_rows", "raw_rows", "processed_timestamp",
                    "processing_status"))


oracle("promote_files", f""", {_MANIFEST_SQL}
SELECT path AS source_path, regexp_replace(path, '^raw/', 'processed/') AS path, record_count, record_count AS processed_rows,
  record_count AS raw_rows, {RUN_TS} + INTERVAL 1 HOUR AS processed_timestamp, 'success' AS processing_status
FROM m WHERE month(landing_date) % 3 <> 0
UNION ALL SELECT regexp_replace(path, '^raw/', 'processed/'), NULL, NULL, NULL, NULL, NULL, 'rejected: expected path under raw/'
FROM m WHERE month(landing_date) % 3 = 0
UNION ALL SELECT 'raw/prod/sage100/1900-01-01/orders.parquet', NULL, NULL, NULL, NULL, NULL, 'rejected: source not found'""")


@query("archive_files")
def _archive(x: Inputs) -> DataFrame:
    """Processed months divisible by 3 and raw ones of January and July moved to the archive, asked for twice.

    Counts are read from the zones' files after the second request;
    ``source_deleted`` is what the listing of the source zone shows.
    """
    root = _landed(x)
    raw = zn.current(x.spark, root, "raw")
    zn.promote(x.spark, root, raw.where(F.month("landing_date") % 3 == 0).select("path"), x.run_ts)
    asked = materialize(zn.current(x.spark, root, "processed").select("path").unionByName(
        raw.where(F.month("landing_date") % 6 == 1).select("path")), "to-archive")
    first = materialize(zn.archive(x.spark, root, asked, x.run_ts + dt.timedelta(hours=2)), "archived")
    again = zn.archive(x.spark, root, asked, x.run_ts + dt.timedelta(hours=3))
    changed = first.exceptAll(again).count() + zn.orphans(x.spark, root).count()
    left = {z: _rows_of(x, root, z, f"{z}_rows").withColumnRenamed("path", "source_path") for z in ("raw", "processed")}
    return (again.join(_rows_of(x, root, "archive", "archive_rows"), "path", "left")
            .join(left["raw"], "source_path", "left").join(left["processed"], "source_path", "left")
            .select("source_path", "path", "record_count", "archive_rows",
                    F.coalesce("raw_rows", "processed_rows", F.lit(0)).alias("source_rows"), "archived_timestamp",
                    "source_deleted", F.lit(changed == 0).alias("second_run_unchanged")))


oracle("archive_files", f""", {_MANIFEST_SQL},
asked AS (SELECT regexp_replace(path, '^raw/', 'processed/') AS source_path, * EXCLUDE (path), regexp_replace(path, '^raw/', 'archive/') AS path
          FROM m WHERE month(landing_date) % 3 = 0
          UNION ALL SELECT path, * EXCLUDE (path), regexp_replace(path, '^raw/', 'archive/') FROM m WHERE month(landing_date) % 6 = 1)
SELECT source_path, path, record_count, record_count AS archive_rows, CAST(0 AS BIGINT) AS source_rows,
  {RUN_TS} + INTERVAL 2 HOUR AS archived_timestamp, TRUE AS source_deleted, TRUE AS second_run_unchanged FROM asked""")


@query("retention_tiers")
def _retention(x: Inputs) -> DataFrame:
    m = _orders_manifest(x)
    return mf.retention_tiers(m, x.as_of).select("path", "landing_date", "age_days", "storage_tier")


oracle("retention_tiers", f""", {_MANIFEST_SQL}
SELECT path, landing_date, CAST(date_diff('day', landing_date, {AS_OF}) AS BIGINT) AS age_days,
  CASE WHEN date_diff('day', landing_date, {AS_OF}) >= 365 THEN 'DELETE'
       WHEN date_diff('day', landing_date, {AS_OF}) >= 90 THEN 'COLDLINE'
       WHEN date_diff('day', landing_date, {AS_OF}) >= 30 THEN 'NEARLINE' ELSE 'STANDARD' END AS storage_tier
FROM m""")


# ---------------------------------------------------------------- quality
RAW_CHECK_COLS = ("transaction_id", "sku_id", "vendor_id", "warehouse_id", "quantity", "transaction_type",
                  "unit_cost", "transaction_timestamp")


@query("completeness")
def _completeness(x: Inputs) -> DataFrame:
    return qa.completeness(x.raw, RAW_CHECK_COLS)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _miss(c: str, string: bool) -> str:
    return f"({c} IS NULL OR {c} = '')" if string else f"({c} IS NULL)"


_STRING_RAW = {"transaction_id", "sku_id", "vendor_id", "warehouse_id", "transaction_type"}
oracle("completeness", _union([
    f"""SELECT '{c}' AS "column", CAST(count_if({_miss(c, c in _STRING_RAW)}) AS BIGINT) AS null_count, COUNT(*) AS row_count,
      ROUND(count_if({_miss(c, c in _STRING_RAW)}) / COUNT(*), 6) AS null_rate,
      ROUND(1.0::DOUBLE - count_if({_miss(c, c in _STRING_RAW)}) / COUNT(*), 6) AS completeness
    FROM raw_inventory_transactions""" for c in RAW_CHECK_COLS]))

PROFILE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("distribution_profile")
def _profile(x: Inputs) -> DataFrame:
    return qa.profile(x.table("lineitem"), PROFILE_COLS)


oracle("distribution_profile", _union([
    f"""SELECT '{c}' AS "column", ROUND(avg({c}), 6) AS mean, ROUND(stddev_samp({c}), 6) AS std,
      ROUND(min({c}), 6) AS min, ROUND(max({c}), 6) AS max, COUNT({c}) AS count FROM lineitem"""
    for c in PROFILE_COLS]))


@query("feature_validation")
def _feature_validation(x: Inputs) -> DataFrame:
    return qa.validate_features(read_latest_snapshot(x.features_table))


def _fv_sql() -> str:
    parts = []
    for c in qa.REQUIRED_FEATURES:
        miss = _miss(c, c == "sku_id")
        parts.append(f"""SELECT 'completeness' AS "check", '{c}' AS "column", 'completeness' AS metric,
          ROUND(ROUND(1.0::DOUBLE - count_if({miss}) / COUNT(*), 6), 4) AS value,
          (1.0::DOUBLE - count_if({miss}) / COUNT(*)) >= 0.95 AS passed FROM features""")
    for c in qa.NUMERIC_FEATURES:
        for m, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            parts.append(f"""SELECT 'distribution', '{c}', '{m}', ROUND(ROUND(CAST({f}({c}) AS DOUBLE), 4), 6), TRUE FROM features""")
    parts.append("SELECT 'row_count', NULL, 'rows', CAST(COUNT(*) AS DOUBLE), COUNT(*) > 0 FROM features")
    body = _union(parts)
    return f""", fv AS ({body})
SELECT * FROM fv UNION ALL
SELECT 'verdict', NULL, 'passed', CAST(bool_and(passed) AS DOUBLE), bool_and(passed) FROM fv"""


oracle("feature_validation", _fv_sql())


@query("row_count_check")
def _row_count(x: Inputs) -> DataFrame:
    return qa.row_count_check(x.staged, 1)


oracle("row_count_check", "SELECT COUNT(*) AS row_count, CAST(1 AS BIGINT) AS minimum, COUNT(*) >= 1 AS passed FROM staged")

RAW_TYPES = {"transaction_id": "string", "sku_id": "date", "warehouse_id": "int", "quantity": "int",
             "transaction_type": "string", "unit_cost": "float", "transaction_timestamp": "timestamp",
             "source_system": "uuid"}


@query("type_check")
def _type_check(x: Inputs) -> DataFrame:
    return qa.type_check(x.raw, RAW_TYPES)


oracle("type_check", """
SELECT 'transaction_id' AS "column", 'string' AS expected_type, CAST(count_if(transaction_id IS NOT NULL AND transaction_id <> '') AS BIGINT) AS checked,
  CAST(0 AS BIGINT) AS bad_count, CAST(NULL AS VARCHAR) AS first_bad_value, CAST(NULL AS VARCHAR) AS error FROM raw_inventory_transactions
UNION ALL
SELECT 'sku_id', 'date', CAST(count_if(sku_id IS NOT NULL AND sku_id <> '') AS BIGINT),
  CAST(count_if(sku_id IS NOT NULL AND sku_id <> '' AND length(sku_id) < 8) AS BIGINT),
  min(CASE WHEN sku_id <> '' AND length(sku_id) < 8 THEN sku_id END),
  CASE WHEN count_if(sku_id <> '' AND length(sku_id) < 8) > 0 THEN 'Column ''sku_id'' expected type ''date'', got value '
    || min(CASE WHEN sku_id <> '' AND length(sku_id) < 8 THEN sku_id END) END FROM raw_inventory_transactions
UNION ALL
SELECT 'warehouse_id', 'int', CAST(count_if(warehouse_id IS NOT NULL AND warehouse_id <> '') AS BIGINT),
  CAST(count_if(warehouse_id <> '' AND TRY_CAST(warehouse_id AS BIGINT) IS NULL) AS BIGINT),
  min(CASE WHEN warehouse_id <> '' AND TRY_CAST(warehouse_id AS BIGINT) IS NULL THEN warehouse_id END),
  CASE WHEN count_if(warehouse_id <> '' AND TRY_CAST(warehouse_id AS BIGINT) IS NULL) > 0 THEN 'Column ''warehouse_id'' expected type ''int'', got value '
    || min(CASE WHEN warehouse_id <> '' AND TRY_CAST(warehouse_id AS BIGINT) IS NULL THEN warehouse_id END) END FROM raw_inventory_transactions
UNION ALL
SELECT 'quantity', 'int', count(quantity), 0, NULL, NULL FROM raw_inventory_transactions
UNION ALL
SELECT 'transaction_type', 'string', CAST(count_if(transaction_type IS NOT NULL AND transaction_type <> '') AS BIGINT), 0, NULL, NULL FROM raw_inventory_transactions
UNION ALL
SELECT 'unit_cost', 'float', CAST(count_if(unit_cost IS NOT NULL AND NOT isnan(unit_cost)) AS BIGINT), 0, NULL, NULL FROM raw_inventory_transactions
UNION ALL
SELECT 'transaction_timestamp', 'timestamp', count(transaction_timestamp), 0, NULL, NULL FROM raw_inventory_transactions
UNION ALL
SELECT 'source_system', 'uuid', 0, 0, NULL, 'Unknown expected type ''uuid'' for column ''source_system''' """)

RAW_RULE_COLUMNS = {"transaction_id": "string", "sku_id": "string", "vendor_id": "string",
                    "warehouse_id": "string", "quantity": "int", "transaction_type": "string",
                    "unit_cost": "float", "transaction_timestamp": "timestamp", "source_system": "string",
                    "source_file": "string", "po_number": "string"}
RAW_REQUIRED = ("transaction_id", "sku_id", "vendor_id", "quantity", "transaction_type", "transaction_timestamp")


@query("validate_dataset")
def _validate_dataset(x: Inputs) -> DataFrame:
    return qa.validate_dataset(x.raw, RAW_RULE_COLUMNS, RAW_REQUIRED)


def _vd_sql() -> str:
    nulls = _union([
        f"""SELECT 'null_rate' AS "check", '{c}' AS "column",
          CASE WHEN count_if({_miss(c, c in _STRING_RAW)}) / COUNT(*) > 0.05 THEN 'error' ELSE 'info' END AS severity,
          ROUND(count_if({_miss(c, c in _STRING_RAW)}) / COUNT(*), 6) AS value,
          'null_count=' || count_if({_miss(c, c in _STRING_RAW)}) || ' rows=' || COUNT(*) AS detail
        FROM raw_inventory_transactions""" for c in RAW_REQUIRED])
    return f""", vd AS (
SELECT 'schema_missing' AS "check", 'po_number' AS "column", 'error' AS severity, CAST(NULL AS DOUBLE) AS value,
  'Missing required column' AS detail
UNION ALL SELECT 'schema_extra', 'tie_key', 'warning', NULL, 'Unexpected column (will be ignored)'
UNION ALL {nulls})
SELECT * FROM vd UNION ALL
SELECT 'verdict', NULL, CASE WHEN count_if(severity = 'error') = 0 THEN 'info' ELSE 'error' END, CAST(count_if(severity = 'error') AS DOUBLE),
  CASE WHEN count_if(severity = 'error') = 0 THEN 'valid' ELSE 'invalid' END FROM vd"""


oracle("validate_dataset", _vd_sql())


@query("table_stats")
def _table_stats(x: Inputs) -> DataFrame:
    """Lineitem partitioned by ship month (none for every seventh line): counts from footers and folder names."""
    path = shared_dir(x.spark, "lineitem-by-month")
    month = F.when(F.col("l_linenumber") != 7, F.trunc(F.to_date("l_shipdate"), "month"))
    sk.write_table(x.table("lineitem").withColumn("ship_month", month), path, "WRITE_TRUNCATE", partition_by=("ship_month",))
    stats = qa.table_stats(x.spark, {"lineitem": path})
    return stats.select("table_name", "row_count", "num_partitions", (F.col("size_bytes") > 0).alias("has_bytes"),
                        (F.col("num_files") >= F.col("num_partitions")).alias("has_files"))


oracle("table_stats", """
SELECT 'lineitem' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count,
  COUNT(DISTINCT CASE WHEN l_linenumber <> 7 THEN date_trunc('month', l_shipdate) END) AS num_partitions,
  TRUE AS has_bytes, TRUE AS has_files FROM lineitem""")

# Columns whose footers are held against the rows.
STATS_COLUMNS = {"lineitem": ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"),
                 "orders": ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
                 "customer": ("c_custkey", "c_acctbal", "c_name")}
_TIMES, _TEXTS = ("l_shipdate", "o_orderdate"), ("l_returnflag", "c_name")


@query("column_stats", exact=("low", "high"))
def _column_stats(x: Inputs) -> DataFrame:
    """Values, nulls and bounds per column out of Parquet footers, with every fifth value taken out."""
    paths = {}
    for name, columns in STATS_COLUMNS.items():
        paths[name] = shared_dir(x.spark, f"stats-{name}")
        key = F.col(columns[0])
        (x.table(name).select(*[F.when(key % 5 != 0, F.col(c)).alias(c) for c in columns])
         .write.parquet(paths[name]))
    return qa.column_stats(x.spark, paths)


def _column_stats_sql() -> str:
    parts = []
    for name, columns in STATS_COLUMNS.items():
        for c in columns:
            v = f"CASE WHEN {columns[0]} % 5 <> 0 THEN {f'epoch({c})' if c in _TIMES else c} END"
            low, high = ("CAST(NULL AS DOUBLE)",) * 2 if c in _TEXTS else (f"CAST(min({v}) AS DOUBLE)", f"CAST(max({v}) AS DOUBLE)")
            parts.append(f"""SELECT '{name}' AS table_name, '{c}' AS "column", COUNT(*) AS n_values,
              COUNT(*) - COUNT({v}) AS n_nulls, {low} AS low, {high} AS high FROM {name}""")
    return _union(parts)


oracle("column_stats", _column_stats_sql())

# Layer of each driver table in the health report.
HEALTH_LAYERS = {"region": "reference", "nation": "reference", "part": "reference", "supplier": "reference",
                 "customer": "reference", "orders": "transactions", "lineitem": "transactions",
                 "events": "stream", "conversations": "stream", "documents": "content", "pages": "content",
                 "benchmark": "content", "labels": "content", "embeddings": "content"}


@query("table_health")
def _table_health(x: Inputs) -> DataFrame:
    cat = {name: (layer, f"{x.sf_dir}/{name}.parquet") for name, layer in HEALTH_LAYERS.items()}
    return qa.table_health(x.spark, cat, top=5)


@query("validate_required")
def _validate_required(x: Inputs) -> DataFrame:
    return st.tag_validity(x.raw).select("transaction_id", "reject_reasons", "is_valid")


oracle("validate_required", """
SELECT transaction_id, concat_ws(';', CASE WHEN transaction_id IS NULL THEN 'missing:transaction_id' END,
    CASE WHEN sku_id IS NULL THEN 'missing:sku_id' END, CASE WHEN quantity IS NULL THEN 'missing:quantity' END,
    CASE WHEN transaction_type IS NULL THEN 'missing:transaction_type' END) AS reject_reasons,
  sku_id IS NOT NULL AND transaction_id IS NOT NULL AND quantity IS NOT NULL AND transaction_type IS NOT NULL AS is_valid
FROM raw_inventory_transactions""")


@query("enrich_metadata")
def _enrich(x: Inputs) -> DataFrame:
    return st.enrich_metadata(x.raw, x.run_id, x.run_ts).select(
        "transaction_id", "source_system", "ingestion_date", "pipeline_run_id", "_ingested_at")


oracle("enrich_metadata", f"""
SELECT transaction_id, COALESCE(source_system, 'sage100') AS source_system, CAST({RUN_TS} AS DATE) AS ingestion_date,
  {RUN_ID} AS pipeline_run_id, {RUN_TS} AS _ingested_at FROM raw_inventory_transactions""")


# ------------------------------------------------------------- governance
@query("delete_entities", exact=("o_totalprice",))
def _delete_entities(x: Inputs) -> DataFrame:
    """Right to deletion: customers with negative balance ask to be forgotten."""
    ids = x.table("customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return gv.delete_entities(x.table("orders"), ids, "o_custkey").select(
        "o_orderkey", "o_custkey", "o_totalprice")


oracle("delete_entities", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IS NOT NULL)""")


@query("pii_projection", exact=("c_acctbal",))
def _pii(x: Inputs) -> DataFrame:
    return gv.pii_projection(x.table("customer"), ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"],
                             hash_ids=["c_custkey"])


oracle("pii_projection", """
SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM customer""")


@query("expire_partitions")
def _expire(x: Inputs) -> DataFrame:
    """Staging retention 180 d: what each transaction date keeps or drops."""
    return gv.expiry_report(x.staged, "transaction_date", x.as_of, 180)


oracle("expire_partitions", f"""
SELECT transaction_date, COUNT(*) AS n_rows, transaction_date < {AS_OF} - 180 AS expired
FROM staged GROUP BY transaction_date""")


@query("drift_ks")
def _drift(x: Inputs) -> DataFrame:
    li = x.table("lineitem")
    y = F.year("l_shipdate")
    return gv.drift_ks(li.where(y == 1996), li.where(y == 2000), ["l_quantity", "l_extendedprice"])


def _ks_sql() -> str:
    s = _union([f"""SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CASE WHEN year(l_shipdate) = 1996 THEN 1 ELSE 2 END AS sample
      FROM lineitem WHERE year(l_shipdate) IN (1996, 2000) AND {c} IS NOT NULL""" for c in ("l_quantity", "l_extendedprice")])
    return f""", s AS ({s}),
c AS (SELECT feature, value, count_if(sample = 1) AS n1, count_if(sample = 2) AS n2 FROM s GROUP BY feature, value),
t AS (SELECT feature, SUM(n1) AS t1, SUM(n2) AS t2 FROM c GROUP BY feature),
f AS (SELECT c.feature, abs(SUM(n1) OVER (PARTITION BY c.feature ORDER BY value) / t1
                         - SUM(n2) OVER (PARTITION BY c.feature ORDER BY value) / t2) AS gap
      FROM c JOIN t ON c.feature = t.feature),
d AS (SELECT f.feature, max(gap) AS ks, any_value(t1) AS n1, any_value(t2) AS n2 FROM f JOIN t ON f.feature = t.feature GROUP BY f.feature),
l AS (SELECT *, (sqrt(n1 * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1 * n2 / (n1 + n2))) * ks AS lam FROM d)
SELECT feature, CAST(n1 AS BIGINT) AS n_base, CAST(n2 AS BIGINT) AS n_current, ROUND(ks, 6) AS ks_statistic,
  ROUND(least(1.0, greatest(0.0, list_sum([2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * lam * lam)
        FOR k IN range(1, 101)]))), 6) AS p_value,
  least(1.0, greatest(0.0, list_sum([2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * lam * lam)
        FOR k IN range(1, 101)]))) < 0.05 AS drift_alert
FROM l"""


oracle("drift_ks", _ks_sql())


# ------------------------------------------------------- rejects and dispositions
@query("staging_rejects")
def _staging_rejects(x: Inputs) -> DataFrame:
    """What staging leaves out, by reason."""
    return st.staging_rejects(x.raw).groupBy("reject_reasons").agg(F.count(F.lit(1)).alias("n_rows"))


oracle("staging_rejects", """
SELECT reasons AS reject_reasons, COUNT(*) AS n_rows FROM (
  SELECT concat_ws(';', CASE WHEN sku_id IS NULL THEN 'missing:sku_id' END,
                        CASE WHEN quantity = 0 THEN 'zero_quantity' END) AS reasons
  FROM raw_inventory_transactions) r WHERE reasons <> '' GROUP BY 1""")


@query("csv_rejects")
def _csv_rejects(x: Inputs) -> DataFrame:
    """CSV files with bad numbers and surplus fields: every record is a good row or a reject."""
    path = shared_dir(x.spark, "landing-dirty")
    qty = F.col("l_quantity").cast("long").cast("string")
    dirty = F.when(F.col("l_orderkey") % 13 == 0, F.concat(F.lit("x"), qty)).when(
        F.col("l_orderkey") % 17 == 0, F.concat(qty, F.lit(",surplus"))).otherwise(qty)
    (x.table("lineitem").select(F.col("l_orderkey").alias("order_id"), dirty.alias("quantity"))
     .write.option("header", "true").option("quote", "\u0000").csv(path))
    good, rejects = ld.read_landing_checked(x.spark, path, "csv", T.StructType([
        T.StructField("order_id", T.LongType()), T.StructField("quantity", T.LongType())]))
    return good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n_rows"),
                    F.sum("quantity").alias("quantity")).unionByName(
        rejects.agg(F.lit("reject").alias("kind"), F.count(F.lit(1)).alias("n_rows"),
                    F.lit(None).cast("long").alias("quantity")))


oracle("csv_rejects", """
SELECT CASE WHEN l_orderkey % 13 = 0 OR l_orderkey % 17 = 0 THEN 'reject' ELSE 'good' END AS kind, COUNT(*) AS n_rows,
  CAST(SUM(CASE WHEN l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0 THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS quantity
FROM lineitem GROUP BY 1""")


@query("write_dispositions")
def _write_dispositions(x: Inputs) -> DataFrame:
    """Rows in a partitioned table after each kind of write."""
    path, rows = shared_dir(x.spark, "dispositions"), []
    orders = x.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    steps = (("1 truncate", "WRITE_TRUNCATE", F.lit(True)),
             ("2 replace F", "REPLACE_PARTITIONS", (F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 2 == 0)),
             ("3 append P", "WRITE_APPEND", F.col("o_orderstatus") == "P"),
             ("4 truncate to O", "WRITE_TRUNCATE", F.col("o_orderstatus") == "O"))
    for name, mode, keep in steps:
        sk.write_table(orders.where(keep), path, mode, partition_by=("o_orderstatus",))
        counted = x.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))
        rows.append(materialize(counted.select(F.lit(name).alias("step"), "o_orderstatus", "n_rows"), "disposition-rows"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


oracle("write_dispositions", """
, s1 AS (SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1),
ev AS (SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 2 = 0),
s2 AS (SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN (SELECT n FROM ev) ELSE n END AS n FROM s1)
SELECT '1 truncate' AS step, o_orderstatus, n AS n_rows FROM s1
UNION ALL SELECT '2 replace F', o_orderstatus, n FROM s2
UNION ALL SELECT '3 append P', o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 2 * n ELSE n END FROM s2
UNION ALL SELECT '4 truncate to O', o_orderstatus, n FROM s1 WHERE o_orderstatus = 'O'""")


@query("delete_rewrite")
def _delete_rewrite(x: Inputs) -> DataFrame:
    """The deletion list applied to a stored table, the partition of rows without a status included."""
    path = shared_dir(x.spark, "deletion")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    stored = x.table("orders").select("o_orderkey", "o_custkey", status.alias("status"))
    sk.write_table(stored, path, "WRITE_TRUNCATE", partition_by=("status",))
    ids = x.table("customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    gv.rewrite_without(x.spark.read.parquet(path), ids, "o_custkey", path, ("status",))
    x.spark.catalog.refreshByPath(path)
    return x.spark.read.parquet(path).select("o_orderkey", "o_custkey", "status")


oracle("delete_rewrite", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IS NOT NULL)""")
