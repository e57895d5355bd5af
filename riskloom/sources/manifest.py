"""Manifest rows as DataFrames: what a batch lands, what is unprocessed, how old it is.

Zones are path prefixes raw/ processed/ staging/ archive/; a landed file
is identified by its logical path ``<zone>/<env>/<source>/<date>/<file>``.
Landing, promoting and archiving the data itself is in ``zones``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.fixtures import run_ts_lit

# Zone prefixes and content types by file suffix.
RAW, PROCESSED, STAGING, ARCHIVE = "raw/", "processed/", "staging/", "archive/"
CONTENT_TYPES = {"parquet": "application/octet-stream", "csv": "text/csv",
                 "json": "application/json", "jsonl": "application/x-ndjson"}

MANIFEST_COLUMNS = ("path", "zone", "source_system", "landing_date", "ingestion_timestamp",
                    "schema_version", "record_count", "pipeline_run_id", "original_filename",
                    "content_type")


def logical_path(zone: str, env: str, source_system: str, date_col: Column, filename: str) -> Column:
    return F.concat(F.lit(f"{zone}{env}/{source_system}/"), F.date_format(date_col, "yyyy-MM-dd"),
                    F.lit(f"/{filename}"))


def planned_entries(df: DataFrame, source_system: str, partition_col: str, run_id: str, run_ts: dt.datetime,
                    schema_version: str = "v1.0", env: str = "prod", filename: str = "data.parquet") -> DataFrame:
    """The manifest rows a batch will have when ``zones.land`` has written it: one per date, with its record count."""
    fmt = filename.rsplit(".", 1)[-1]
    counts = df.groupBy(F.col(partition_col).cast("date").alias("landing_date")).agg(
        F.count(F.lit(1)).alias("record_count"))
    return counts.select(
        logical_path(RAW, env, source_system, F.col("landing_date"), filename).alias("path"),
        F.lit("raw").alias("zone"),
        F.lit(source_system).alias("source_system"),
        "landing_date",
        run_ts_lit(run_ts).alias("ingestion_timestamp"),
        F.lit(schema_version).alias("schema_version"),
        "record_count",
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(filename).alias("original_filename"),
        F.lit(CONTENT_TYPES.get(fmt, "application/octet-stream")).alias("content_type"),
    )


def zone_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^([a-z]+)/", 1)


def unprocessed_files(raw_paths: DataFrame, processed_paths: DataFrame) -> DataFrame:
    """Raw paths without a processed copy (processed/x maps back to raw/x), sorted."""
    raw = raw_paths.select("path").where(F.col("path").startswith(RAW))
    done = (processed_paths.where(F.col("path").startswith(PROCESSED))
            .select(F.regexp_replace("path", f"^{PROCESSED}", RAW).alias("path")))
    return raw.join(done, "path", "left_anti").distinct().orderBy("path")


def promote_files(manifest: DataFrame, paths: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """What promoting these paths will give, from the manifest alone (``zones.promote`` does it); non-raw paths are rejected."""
    req = paths.select(F.col("path").alias("source_path"))
    ok = F.col("source_path").startswith(RAW)
    m = manifest.alias("m")
    j = req.join(m, F.col("source_path") == F.col("m.path"), "left")
    status = (F.when(~ok, F.lit("rejected: expected path under raw/"))
              .when(F.col("m.path").isNull(), F.lit("rejected: source not found"))
              .otherwise(F.lit("success")))
    return j.select(
        "source_path",
        F.when(ok & F.col("m.path").isNotNull(),
               F.regexp_replace("source_path", f"^{RAW}", PROCESSED)).alias("path"),
        F.col("m.record_count").alias("record_count"),
        F.when(status == "success", run_ts_lit(run_ts)).alias("processed_timestamp"),
        status.alias("processing_status"),
    )


def archive_files(manifest: DataFrame, paths: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """What archiving these paths will give, from the manifest alone (``zones.archive`` does it)."""
    req = paths.select(F.col("path").alias("source_path"))
    rel = F.regexp_replace("source_path", f"^({RAW}|{PROCESSED}|{STAGING})", "")
    m = manifest.alias("m")
    j = req.join(m, F.col("source_path") == F.col("m.path"), "left")
    found = F.col("m.path").isNotNull()
    return j.select(
        "source_path",
        F.when(found, F.concat(F.lit(ARCHIVE), rel)).alias("path"),
        F.col("m.record_count").alias("record_count"),
        F.when(found, run_ts_lit(run_ts)).alias("archived_timestamp"),
        found.alias("source_deleted"),
    )


# Storage tiers by age in days.
TIER_NEARLINE_DAYS, TIER_COLDLINE_DAYS, TIER_DELETE_DAYS = 30, 90, 365


def retention_tiers(manifest: DataFrame, as_of: dt.date, date_col: str = "landing_date",
                    nearline: int = TIER_NEARLINE_DAYS, coldline: int = TIER_COLDLINE_DAYS,
                    delete: int = TIER_DELETE_DAYS) -> DataFrame:
    """Storage class by age: STANDARD < nearline <= NEARLINE < coldline <= COLDLINE < delete <= DELETE."""
    age = F.datediff(F.lit(as_of), F.col(date_col).cast("date"))
    tier = (F.when(age >= delete, F.lit("DELETE")).when(age >= coldline, F.lit("COLDLINE"))
            .when(age >= nearline, F.lit("NEARLINE")).otherwise(F.lit("STANDARD")))
    return manifest.withColumn("age_days", age.cast("long")).withColumn("storage_tier", tier)
