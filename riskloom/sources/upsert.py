"""Upsert into a partitioned Parquet table: newest version per key, touched partitions only.

The partitions to rewrite are those of the incoming rows and those where
their keys are now (a key may move to another partition). Their rows and the
incoming ones are merged to the newest version of each key, and just these
partitions are replaced; the rest of the table is neither read (but for its
keys) nor written. A partition that all its rows have left is removed.

The merged rows are stored before any partition is replaced. An upsert that
is broken off can be repeated with the same batch: the newest version of a
key is the same, whether or not the table has it already.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.staging import dedup_sized
from riskloom.sources.files import list_files, remove_folders
from riskloom.sources.sinks import write_table
from riskloom.streaming.runner import materialize

REPORT = ("rows_in bigint, inserted bigint, updated bigint, unchanged bigint, partitions_rewritten bigint, "
          "partitions_removed bigint")


def same_parts(left: DataFrame, right: DataFrame, parts: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on partition columns where NULL equals NULL."""
    other = right.select(*[F.col(c).alias(f"__p_{c}") for c in parts])
    on = F.lit(True)
    for c in parts:
        on = on & F.col(c).eqNullSafe(F.col(f"__p_{c}"))
    return left.join(other, on, how)


def partition_folders(table: DataFrame, values: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(folder) of the partitions of a file table with these values; only file names and partition values are read."""
    where = table.select(*parts, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"))
    return same_parts(where, values.select(*parts).distinct(), parts, "left_semi").select("folder").distinct()


def upsert(spark: SparkSession, batch: DataFrame, path: str, key: str, order: Sequence[Column],
           partition_by: Sequence[str], cluster_by: Sequence[str] = (),
           derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Merge a batch into the table at ``path`` (made if it isn't there); returns one row of counts.

    ``order`` ranks the versions of a key, the newest first, over columns of
    the table but the ``derived`` ones, which follow from others of their row
    (name and expression) and are computed again instead of shuffled. rows_in: keys of the batch; inserted: new ones; updated: those
    whose row changed; unchanged: the others.
    """
    parts, columns, derived = list(partition_by), list(batch.columns), dict(derived or {})

    def latest(rows: DataFrame) -> DataFrame:
        return dedup_sized(rows.drop(*derived), key, order).withColumns(derived).select(*columns)
    newest = latest(batch)
    if list_files(spark, path, "*.parquet").isEmpty():
        # A first batch goes straight into the table, and is counted there.
        write_table(newest, path, "WRITE_TRUNCATE", partition_by=parts, cluster_by=cluster_by, derived=derived)
        n = spark.read.schema(batch.schema).parquet(path).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*parts)).alias("p")).first()
        return spark.createDataFrame([(n.n, n.n, 0, 0, n.p, 0)], REPORT)

    incoming = materialize(newest, "upsert-batch")
    table = spark.read.parquet(path).select(*columns)
    now = table.select(key, *parts).join(incoming.select(key), key, "left_semi").select(*parts)
    touched = materialize(incoming.select(*parts).unionByName(now).distinct(), "upsert-partitions")
    old = same_parts(table, touched, parts, "left_semi")
    merged = materialize(latest(old.unionByName(incoming)), "upsert-merged")

    # Versions before and after, of the batch's keys only.
    digest = F.xxhash64(*[F.col(c) for c in columns])
    before = old.join(incoming.select(key), key, "left_semi").groupBy(key).agg(F.min(digest).alias("was"))
    after = merged.join(incoming.select(key), key, "left_semi").select(key, digest.alias("is"))
    fate = after.join(before, key, "left").agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("was").isNull()).alias("inserted"),
        F.count_if(F.col("was") != F.col("is")).alias("updated"),
        F.count_if(F.col("was") == F.col("is")).alias("unchanged")).first()
    left = merged.select(*parts).distinct()
    emptied = partition_folders(spark.read.parquet(path), same_parts(touched, left, parts, "left_anti"), parts)
    emptied = materialize(emptied, "upsert-emptied")

    write_table(merged, path, "REPLACE_PARTITIONS", partition_by=parts, cluster_by=cluster_by, derived=derived)
    removed = remove_folders(emptied).where("existed").count()
    spark.catalog.refreshByPath(path)
    return spark.createDataFrame([(*fate, left.count(), removed)], REPORT)
