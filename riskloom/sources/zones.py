"""A landing store of four zones with a manifest: land, list, promote, archive.

Data lies in ``<root>/<zone>/attempt=<id>/source_system=<s>/<column>=<date>/``
and the manifest, a Parquet table of its own, in ``<root>/manifest``. A
batch of one source and date is one entry with a logical path
``<zone>/<env>/<source>/<date>/<file name>``.

Every action works in the same steps: write below a new attempt name, count
what was written from the files themselves, compare, then append the entries
to the manifest in one file, which readers see whole or not at all. Only
files that the manifest names are data, so an action that is lost before its
append leaves an attempt nobody reads (``orphans``), and can be repeated.

Archiving moves: the same append adds the archived entries and takes the
sources out (rows with status ``removed``); the files of removed entries are
deleted after it. A driver lost in between leaves files that the next
``remove_files`` deletes, from the manifest alone.

On the driver are only names of the chosen partitions (metadata, as Spark's
own listing); rows and counts stay in Spark.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.files import list_files, remove_folders
from riskloom.sources.fixtures import run_ts_lit
from riskloom.sources.manifest import ARCHIVE, CONTENT_TYPES, PROCESSED, RAW, STAGING

ENTRY = ("path string, zone string, location string, files array<string>, source_system string, landing_date date, "
         "record_count bigint, n_bytes bigint, ingestion_timestamp timestamp_ntz, schema_version string, "
         "pipeline_run_id string, original_filename string, content_type string, status string, source_path string, "
         "stamped_at timestamp_ntz, attempt string")
MANIFEST = "manifest"


class CopyError(RuntimeError):
    """What was written doesn't hold what was to be written; nothing entered the manifest."""


def inside(root: str, path: Column) -> Column:
    """A file's place below the root, whichever way its scheme is written."""
    return F.substring_index(path, re.sub(r"^[a-zA-Z0-9]+:", "", root).strip("/") + "/", -1)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the manifest, entries and removals."""
    # By file, not by folder: Spark takes two listings of one folder for the same scan, even if files came in between.
    files = [r.path for r in list_files(spark, f"{root.rstrip('/')}/{MANIFEST}", "*.parquet").sort("path").collect()]
    return spark.read.schema(ENTRY).parquet(*files) if files else spark.createDataFrame([], ENTRY)


def current(spark: SparkSession, root: str, zone: str | None = None) -> DataFrame:
    """The entries that hold now: committed and not removed. Of several for one path the last stamped."""
    rows = read_manifest(spark, root)
    gone = rows.where("status = 'removed'").select("location")
    live = _last(rows.where("status = 'committed'").join(gone, "location", "left_anti"), "path")
    return live.where(F.col("zone") == zone) if zone else live


def _last(rows: DataFrame, key: str) -> DataFrame:
    """For each key the row stamped last."""
    last = rows.groupBy(F.col(key).alias("k")).agg(F.max(F.struct("stamped_at", "attempt"))["attempt"].alias("a"))
    return rows.join(last, (rows[key] == last.k) & (rows.attempt == last.a), "left_semi")


def _append(entries: DataFrame, root: str) -> None:
    # One task, one file: an append is seen whole or not at all. Rows: one per partition of the action.
    entries.select(*[c.split()[0] for c in ENTRY.split(", ")]).coalesce(1).write.mode("append").parquet(
        f"{root.rstrip('/')}/{MANIFEST}")


def _written(spark: SparkSession, root: str, zone: str, attempt: str, source: str, column: str) -> DataFrame:
    """(source_system, landing_date, location, files, record_count, n_bytes) of an attempt, read from its files."""
    base = f"{root.rstrip('/')}/{zone}/attempt={attempt}/source_system={source}"
    rows = spark.read.parquet(base).select(
        F.col(column).cast("date").alias("landing_date"), inside(root, F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_size").alias("size"))
    per_file = rows.groupBy("landing_date", "file").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    return per_file.groupBy("landing_date").agg(
        F.lit(source).alias("source_system"), F.sum("n").alias("record_count"), F.sum("size").alias("n_bytes"),
        F.sort_array(F.collect_list("file")).alias("files"),
        F.min(_folder(F.col("file"))).alias("location"))


def _path(zone: str, env: str, source: Column, date: Column, name: Column) -> Column:
    day = F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit("undated"))
    return F.concat(F.lit(f"{zone}/{env}/"), source, F.lit("/"), day, F.lit("/"), name)


def land(df: DataFrame, root: str, source_system: str, partition_col: str, run_id: str, run_ts: dt.datetime,
         schema_version: str = "v1.0", env: str = "prod", filename: str = "data.parquet") -> DataFrame:
    """Write a batch into the raw zone, one entry per date; returns its manifest rows.

    Landing a path again replaces its entry (the older files are no longer
    named). Rows without a date are the entry ``undated``; an empty batch
    lands nothing.
    """
    if not re.fullmatch(r"[\w.-]+", source_system):
        raise ValueError(f"source system {source_system!r} can't be part of a path")
    spark, attempt, root = df.sparkSession, uuid.uuid4().hex, root.rstrip("/")
    folder = f"{root}/raw/attempt={attempt}/source_system={source_system}"
    df.hint("rebalance", partition_col).write.mode("error").partitionBy(partition_col).parquet(folder)
    if list_files(spark, folder).isEmpty():
        return spark.createDataFrame([], ENTRY)
    kind = CONTENT_TYPES.get(filename.rsplit(".", 1)[-1], "application/octet-stream")
    got = _written(spark, root, "raw", attempt, source_system, partition_col).select(
        "*", _path("raw", env, F.lit(source_system), F.col("landing_date"), F.lit(filename)).alias("path"),
        F.lit("raw").alias("zone"), run_ts_lit(run_ts).alias("ingestion_timestamp"),
        F.lit(schema_version).alias("schema_version"), F.lit(run_id).alias("pipeline_run_id"),
        F.lit(filename).alias("original_filename"), F.lit(kind).alias("content_type"),
        F.lit("committed").alias("status"), F.lit(None).cast("string").alias("source_path"),
        run_ts_lit(run_ts).alias("stamped_at"), F.lit(attempt).alias("attempt"))
    _append(got, root)
    return read_manifest(spark, root).where(F.col("attempt") == attempt)


def unprocessed(spark: SparkSession, root: str) -> DataFrame:
    """Paths of the raw zone without a copy in the processed zone, sorted."""
    done = current(spark, root, "processed").select(F.regexp_replace("path", f"^{PROCESSED}", RAW).alias("path"))
    return current(spark, root, "raw").select("path").join(done, "path", "left_anti").orderBy("path")


def read_entries(spark: SparkSession, root: str, entries: DataFrame, path_column: str = "entry_path") -> DataFrame:
    """The rows of the entries, with the path of each row's entry; only their folders are read."""
    root = root.rstrip("/")
    chosen = entries.select("path", "location").distinct()
    groups: dict[str, list[str]] = {}
    for _, location in chosen.collect():  # a name per partition of the action
        groups.setdefault(location.rsplit("/", 1)[0], []).append(f"{root}/{location}")
    out = None
    for base, folders in sorted(groups.items()):
        rows = spark.read.option("basePath", f"{root}/{base}").parquet(*folders)
        rows = rows.withColumn("__location", _folder(inside(root, F.col("_metadata.file_path"))))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], f"`{path_column}` string")
    names = chosen.select(F.col("location").alias("__location"), F.col("path").alias(path_column))
    return out.join(names, "__location").drop("__location")


def _batches(entries: DataFrame) -> list[DataFrame]:
    """The entries by batch: one zone, environment, source and file name, so a date occurs once in each."""
    batch = F.regexp_replace("path", r"/[^/]*/([^/]*)$", "/$1")
    return [entries.where(batch == r[0]) for r in entries.select(batch).distinct().collect()]


def _copy(spark: SparkSession, root: str, entries: DataFrame, zone: str, attempt: str) -> DataFrame:
    """Copies a batch's entries to a zone; returns what the new files hold, if that is all of it."""
    root, source, by_base = root.rstrip("/"), None, {}
    for source, location in entries.select("source_system", "location").distinct().collect():  # names of partitions
        by_base.setdefault(location.rsplit("/", 1)[0], []).append(f"{root}/{location}")
    column = location.rsplit("/", 1)[1].split("=", 1)[0]
    rows = None
    for base, folders in sorted(by_base.items()):
        more = spark.read.option("basePath", f"{root}/{base}").parquet(*folders)
        rows = more if rows is None else rows.unionByName(more, allowMissingColumns=True)
    target = f"{root}/{zone}/attempt={attempt}/source_system={source}"
    rows.hint("rebalance", column).write.mode("error").partitionBy(column).parquet(target)
    got = _written(spark, root, zone, attempt, source, column)
    both = entries.select("landing_date", F.col("record_count").alias("want")).alias("w").join(
        got.alias("g"), F.col("w.landing_date").eqNullSafe(F.col("g.landing_date")), "full")
    wrong = both.where(~F.col("want").eqNullSafe(F.col("record_count"))).count()
    if wrong:
        raise CopyError(f"{wrong} partitions of attempt {attempt} in zone {zone} differ from their source")
    return got


def _moved(entries: DataFrame, copied: DataFrame, zone: str, run_ts: dt.datetime, attempt: str) -> DataFrame:
    """Manifest rows of the copies."""
    relative = F.regexp_replace("e.path", f"^({RAW}|{PROCESSED}|{STAGING})", "")
    on = F.col("e.landing_date").eqNullSafe(F.col("c.landing_date"))
    return entries.alias("e").join(copied.alias("c"), on).select(
        F.concat(F.lit(f"{zone}/"), relative).alias("path"), F.lit(zone).alias("zone"), "c.location", "c.files",
        "e.source_system", "e.landing_date", "c.record_count", "c.n_bytes", "e.ingestion_timestamp", "e.schema_version",
        "e.pipeline_run_id", "e.original_filename", "e.content_type", F.lit("committed").alias("status"),
        F.col("e.path").alias("source_path"), run_ts_lit(run_ts).alias("stamped_at"), F.lit(attempt).alias("attempt"))


def promote(spark: SparkSession, root: str, paths: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Copy raw entries to the processed zone (the raw ones stay); a report row per requested path.

    processing_status: success; or rejected: not below raw/, or no such
    entry. A path that has its copy already keeps it (success, the first
    time stamp), so a repeated request changes nothing.
    """
    asked = paths.select(F.col("path").alias("source_path")).distinct()
    raw = current(spark, root, "raw")
    done = current(spark, root, "processed").select("source_path")
    todo = raw.join(asked, raw.path == asked.source_path, "left_semi").join(
        done, raw.path == done.source_path, "left_anti")
    for batch in _batches(todo):
        attempt = uuid.uuid4().hex
        _append(_moved(batch, _copy(spark, root, batch, "processed", attempt), "processed", run_ts, attempt), root)
    have = current(spark, root, "processed").select(
        "source_path", "path", "record_count", F.col("stamped_at").alias("processed_timestamp"))
    below = F.col("source_path").startswith(RAW)
    status = (F.when(~below, F.lit("rejected: expected path under raw/"))
              .when(F.col("path").isNull(), F.lit("rejected: source not found")).otherwise(F.lit("success")))
    return asked.join(have, "source_path", "left").select(
        "source_path", "path", "record_count", "processed_timestamp", status.alias("processing_status"))


def archive(spark: SparkSession, root: str, paths: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Move entries of any zone to the archive; a report row per requested path.

    The copy is verified, then the manifest takes in the archived entries
    and the removal of the sources in one append, then the source files are
    deleted. ``source_deleted`` is what a listing of the source's folder
    shows afterwards. A repeated request finds the entry archived, deletes
    what is left of the source, and changes nothing else.
    """
    asked = paths.select(F.col("path").alias("source_path")).distinct()
    live = current(spark, root).where(F.col("zone") != "archive")
    todo = live.join(asked, live.path == asked.source_path, "left_semi")
    for batch in _batches(todo):
        attempt = uuid.uuid4().hex
        moved = _moved(batch, _copy(spark, root, batch, "archive", attempt), "archive", run_ts, attempt)
        removed = batch.withColumn("status", F.lit("removed")).withColumn("stamped_at", run_ts_lit(run_ts))
        _append(moved.unionByName(removed), root)
    remove_files(spark, root)
    rows = read_manifest(spark, root)
    have = _last(rows.where("status = 'committed' and zone = 'archive'"), "source_path").select(
        "source_path", "path", "record_count", F.col("stamped_at").alias("archived_timestamp"))
    left = list_files(spark, root).select(_folder(inside(root, F.col("path"))).alias("location"))
    sources = rows.where("status = 'removed'").select("location", F.col("path").alias("source_path"))
    kept = sources.join(left.distinct(), "location", "left_semi").select("source_path").distinct().withColumn("kept", F.lit(True))
    return asked.join(have, "source_path", "left").join(kept, "source_path", "left").select(
        "source_path", "path", "record_count", "archived_timestamp",
        F.when(F.col("path").isNotNull(), F.col("kept").isNull()).otherwise(False).alias("source_deleted"))


def remove_files(spark: SparkSession, root: str) -> int:
    """Delete the folders of removed entries that still have files; how many there were."""
    gone = read_manifest(spark, root).where("status = 'removed'").select("location").distinct()
    left = list_files(spark, root).select(_folder(inside(root, F.col("path"))).alias("location"))
    folders = gone.join(left.distinct(), "location", "left_semi").select(
        F.concat(F.lit(root.rstrip("/") + "/"), "location").alias("folder"))
    return remove_folders(folders).where("existed").count()


def orphans(spark: SparkSession, root: str) -> DataFrame:
    """Files below the root that no row of the manifest names: attempts that never were committed."""
    named = read_manifest(spark, root).select(F.explode("files").alias("file"))
    files = list_files(spark, root).select(inside(root, F.col("path")).alias("file"), "n_bytes")
    return files.where(~F.col("file").startswith(MANIFEST)).join(named, "file", "left_anti")
