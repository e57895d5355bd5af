"""Stream dedup over several micro-batches: hot id, expiry, late rows, broken batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.session import shared_dir
from riskloom.streaming import dedup
from riskloom.streaming.dedup import dedup_batch, one_per_id, run_dedup
from riskloom.streaming.runner import start_foreach_batch

SCHEMA = "id string, t timestamp_ntz, v long"
T0 = dt.datetime(2001, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def source(spark, *batches):
    """One file a batch, read in order."""
    path = shared_dir(spark, "events")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


BATCHES = [
    [("a", at(0), 1), ("a", at(1), 2), ("b", at(2), 3), (None, at(2), 4), (None, at(2), 4)],
    [("a", at(5), 5), ("c", at(6), 6), ("c", at(6), 6)],
    [("d", at(40), 7)],
    [("a", at(41), 8), ("e", at(3), 9), ("f", None, 10)],  # a's first time has expired; e is late, f has no time
]
WANT = [("a", at(0), 1), ("b", at(2), 3), (None, at(2), 4), (None, at(2), 4), ("c", at(6), 6), ("d", at(40), 7), ("a", at(41), 8)]


def test_batches_expiry_and_late_rows(spark):
    base = shared_dir(spark, "dedup")
    got = run_dedup(source(spark, *BATCHES), "dedup", "id", "t", 600, base=base)
    assert rows_of(got) == sorted(WANT, key=repr)
    late = spark.read.parquet(f"{base}/rows").where("outcome = 'late'").select("id", "t", "v")
    assert rows_of(late) == [("e", at(3), 9), ("f", None, 10)]
    kept = {r.id for r in spark.read.parquet(f"{base}/recent").collect()}
    assert "b" not in kept and "d" in kept  # old buckets are gone


@pytest.mark.parametrize("place", ["before", "after"])
def test_a_broken_batch_is_repeated(spark, place):
    base, stream = shared_dir(spark, "dedup"), source(spark, *BATCHES)
    whole, failed = dedup_batch(base, "id", "t", 600), []

    def breaks(batch, batch_id):
        if batch_id == 2 and place == "before":
            raise RuntimeError("lost")
        whole(batch, batch_id)
        if batch_id == 2:
            failed.append(batch_id)
            raise RuntimeError("lost")
    with pytest.raises(Exception):
        q = start_foreach_batch(stream, breaks, f"{base}/_checkpoint")
        q.awaitTermination()
    again = run_dedup(stream, "dedup", "id", "t", 600, base=base)
    assert rows_of(again) == sorted(WANT, key=repr)


def test_hot_id_ships_one_row_a_task(spark):
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
                                    F.lit(at(0)).alias("t"), F.col("id").alias("v"))
    plan = one_per_id(hot, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange hashpartitioning")  # the plan's text runs from the result down
    assert one_per_id(hot, "id", "t").count() == 20001


def test_empty_stream(spark):
    path = shared_dir(spark, "events")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert run_dedup(spark.readStream.schema(SCHEMA).parquet(path), "dedup", "id", "t").count() == 0
    assert dedup.STORE.startswith("id ")
