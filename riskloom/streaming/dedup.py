"""Stream dedup for hot ids: a partial aggregate per micro-batch, then a store of recent ids with expiry.

``dropDuplicatesWithinWatermark`` sends every copy of an id to one task of
each micro-batch. Here a micro-batch is first reduced to one row per id by
an aggregate that combines within every input task, so of an id with a third
of all rows each task ships one row. What is left is joined (anti) with the
ids of earlier batches in the store.

The store is a Parquet table of (id, time) in folders by batch and time
bucket. It holds as much as the watermark needs: with a delay d, an id seen
at t is a duplicate until the watermark (latest time of earlier batches less
d) passes t + d; buckets that can't matter any more are removed after each
batch. Rows later than the watermark can't be checked against the store:
they go to a table of their own, never silently away.

Replays: output, late rows and ids of a batch are written to the batch's own
folders, replacing what a broken attempt left, and a batch only looks at ids
of smaller batch numbers. So a restart gives the rows of an unbroken run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StructField, StructType

from riskloom.session import shared_dir
from riskloom.sources.files import list_files, remove_folders
from riskloom.streaming.runner import idempotent_batch_write, start_foreach_batch

STORE = "id string, seen timestamp_ntz, bucket bigint, batch_id bigint"


def one_per_id(batch: DataFrame, key: str, ts: str, *more: str) -> DataFrame:
    """The earliest row of every id (and value of ``more``); of equal times the smallest hash. Rows without an id all stay."""
    row = F.struct(*[F.col(c) for c in batch.columns])
    # A map has no hash of its own; its JSON has.
    parts = [F.to_json(f.name) if isinstance(f.dataType, MapType) else F.col(f.name) for f in batch.schema.fields]
    first = F.min_by(row, F.struct(F.col(ts), F.xxhash64(*parts))).alias("__row")
    known = batch.where(F.col(key).isNotNull()).groupBy(key, *more).agg(first)
    return known.select("__row.*").unionByName(batch.where(F.col(key).isNull()))


def _recent(spark: SparkSession, store: str, batch_id: int) -> DataFrame:
    """Ids of earlier batches."""
    if list_files(spark, store, "*.parquet").isEmpty():
        return spark.createDataFrame([], STORE)
    return spark.read.schema(STORE).parquet(store).where(F.col("batch_id") < batch_id)


def _seconds(time: Column) -> Column:
    return F.unix_seconds(time.cast("timestamp"))


def dedup_batch(base: str, key: str, ts: str, delay_s: int) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the first row of every id to ``<base>/rows/outcome=new``, late ones to ``outcome=late``.

    A row without a time can't be placed and counts as late. An id may be
    late and in time in one batch: each is kept once.
    """
    store, rows = f"{base}/recent", f"{base}/rows"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        recent = _recent(spark, store, batch_id)
        latest = recent.agg(F.max(_seconds(F.col("seen"))).alias("t")).first().t
        in_time = F.col(ts).isNotNull()
        if latest is not None:
            in_time = in_time & (_seconds(F.col(ts)) >= latest - delay_s)
        tagged = batch.withColumn("outcome", F.when(in_time, F.lit("new")).otherwise(F.lit("late")))
        first = one_per_id(tagged, key, ts, "outcome")
        if latest is not None:
            alive = recent.where(_seconds(F.col("seen")) + delay_s >= latest - delay_s).select(
                F.col("id").alias("__id")).distinct()
            first = first.join(alive, (F.col(key).cast("string") == F.col("__id")) & (F.col("outcome") == "new"), "left_anti")
        idempotent_batch_write(first, rows, batch_id, ("outcome",))
        stored = StructType([*first.schema.fields, StructField("batch_id", LongType())])
        mine = spark.read.schema(stored).parquet(rows).where((F.col("batch_id") == batch_id) & (F.col("outcome") == "new"))
        # Later batches have a watermark of at least the latest time so far less the delay: older ids are not stored at all.
        newest = F.greatest(mine.agg(F.max(_seconds(F.col(ts)))).scalar(), F.lit(latest).cast("long"))
        ids = mine.where(F.col(key).isNotNull() & (_seconds(F.col(ts)) >= newest - 2 * delay_s)).select(
            F.col(key).cast("string").alias("id"), F.col(ts).cast("timestamp_ntz").alias("seen"),
            F.floor(_seconds(F.col(ts)) / delay_s).alias("bucket"))
        idempotent_batch_write(ids, store, batch_id, ("bucket",))
        if latest is not None:
            expire(spark, store, batch_id, latest - delay_s, delay_s)
    return sink


def expire(spark: SparkSession, store: str, batch_id: int, mark: int, delay_s: int) -> int:
    """Remove the store's buckets whose ids are no duplicates any more at the watermark ``mark``; how many there were.

    The watermark of this batch, which may still be replayed, and of all
    later ones is at least ``mark``. A bucket ends at (bucket + 1) * delay.
    """
    old = _recent(spark, store, batch_id).where((F.col("bucket") + 2) * delay_s < mark)
    folders = old.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")).distinct()
    return remove_folders(folders).where("existed").count()


def run_dedup(stream_df: DataFrame, name: str, key: str, ts: str, delay_s: int = 600, base: str | None = None) -> DataFrame:
    """Run a stream to completion through the dedup; the deduplicated rows, read back. ``base`` continues an earlier run."""
    spark = stream_df.sparkSession
    base = base or shared_dir(spark, name)
    q = start_foreach_batch(stream_df, dedup_batch(base, key, ts, delay_s), f"{base}/_checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if list_files(spark, f"{base}/rows", "*.parquet").isEmpty():
        return spark.createDataFrame([], stream_df.schema)
    found = spark.read.parquet(f"{base}/rows").where("outcome = 'new'")
    return found.select(*stream_df.columns)
