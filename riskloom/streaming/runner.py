"""Structured Streaming plumbing: file-source streams, availableNow runs, sinks.

Streams checkpoint into the shared folder named by ``spark.checkpoint.dir``
so a restarted driver or lost executor resumes from the committed offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.session import shared_dir


def read_events_stream(spark: SparkSession, path: str, schema: StructType, glob: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream (Kafka in production: same downstream transforms)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def read_kafka_stream(spark: SparkSession, servers: str, topics: str, options: dict | None = None) -> DataFrame:
    """Kafka source (needs the Kafka connector on the cluster); feed it to ``kafka_envelopes``."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topics).option("includeHeaders", "true"))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def kafka_envelopes(records: DataFrame, attempt_header: str = "delivery_attempt") -> DataFrame:
    """Kafka rows (key, value, topic, partition, offset, timestamp, headers) -> message envelopes.

    message_id = topic/partition/offset (unique and stable on replay); the
    headers become the attributes map; the delivery attempt comes from a
    header when the producer sets one (else 1). Same columns as the file
    fixture, so ``parse_envelope`` and everything after it are unchanged.
    """
    headers = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    attrs = F.map_from_entries(F.transform(headers, lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return records.select(
        F.concat_ws("/", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string"))
        .alias("message_id"),
        "topic",
        F.coalesce(attrs[attempt_header].try_cast("int"), F.lit(1)).alias("delivery_attempt"),
        F.col("timestamp").cast("timestamp_ntz").alias("publish_time"),
        F.col("value").cast("string").alias("data"),
        attrs.alias("attributes"),
    )


def start_ingest(stream_df: DataFrame, out: str, checkpoint: str, trigger: str = "availableNow",
                 partition_by: tuple[str, ...] = (), output_mode: str = "append"):
    """Append a stream to a Parquet table (exactly-once via the checkpointed file sink)."""
    w = (stream_df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()


def start_foreach_batch(stream_df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str):
    return (stream_df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def idempotent_batch_write(batch: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write one micro-batch so that a replay of the same batch id replaces, not duplicates, it.

    ``foreachBatch`` is at-least-once: after a failure the same batch id can
    run again. The batch lands in its own ``batch_id`` partition with
    dynamic partition overwrite, so the retry overwrites its own output.
    """
    (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, "batch_id").parquet(path))


def write_routed(stream_df: DataFrame, base: str, checkpoint: str, route_col: str = "target_table"):
    """Append each micro-batch to its target table (one folder per route value).

    One ``foreachBatch`` write partitioned by the route column: a single
    pass per batch whatever the number of targets; unknown routes land in
    ``target_table=__HIVE_DEFAULT_PARTITION__`` for inspection. Replayed
    batches overwrite their own ``batch_id`` partition (exactly-once output).
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        idempotent_batch_write(batch, base, batch_id, (route_col,))
    return start_foreach_batch(stream_df, sink, checkpoint)


def run_outcomes(stream_df: DataFrame, name: str, status_col: str = "status") -> DataFrame:
    """Run a stream of rows with a status to completion; one table (folder) per status, read back together."""
    spark = stream_df.sparkSession
    base = shared_dir(spark, name)
    q = write_routed(stream_df, f"{base}/data", f"{base}/_checkpoint", status_col)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream_df.schema).parquet(f"{base}/data")


def consume_counters(stream_df: DataFrame, statuses: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Per-micro-batch counters: ``statuses`` maps a batch to (status, error) rows; each batch appends
    (batch_id, status, n_messages, n_raised) to a counters table in the shared folder, read back at the end."""
    spark = stream_df.sparkSession
    base = shared_dir(spark, name)
    out = f"{base}/counters"

    def sink(batch: DataFrame, batch_id: int) -> None:
        counts = statuses(batch).groupBy("status").agg(F.count(F.lit(1)).alias("n_messages"), F.count("error").alias("n_raised"))
        idempotent_batch_write(counts, out, batch_id)

    q = start_foreach_batch(stream_df, sink, f"{base}/_checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema("status string, n_messages bigint, n_raised bigint, batch_id bigint").parquet(out)


def run_to_table(stream_df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream to completion (availableNow) into the shared folder and read it back."""
    spark = stream_df.sparkSession
    base = shared_dir(spark, name)
    out, ckpt = f"{base}/data", f"{base}/_checkpoint"
    q = start_ingest(stream_df, out, ckpt, partition_by=partition_by)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream_df.schema).parquet(out)


def as_event_time(df: DataFrame, col: str, name: str = "event_time") -> DataFrame:
    """Wall-clock NTZ -> TIMESTAMP (UTC session): watermarks need TIMESTAMP."""
    return df.withColumn(name, F.col(col).cast("timestamp"))


def tumbling(df: DataFrame, ts: str, width: str = "1 minute", keys: tuple[str, ...] = (),
             watermark: str = "10 minutes") -> DataFrame:
    """Windowed count per key; append mode emits a window once the watermark passes its end."""
    t = as_event_time(df, ts)
    return (t.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", width).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "n_events"))


def dedup_stream(df: DataFrame, key: str, ts: str, watermark: str = "10 minutes") -> DataFrame:
    """Drop redeliveries of the same key within the watermark delay (bounded state)."""
    t = as_event_time(df, ts, "__event_time")
    return t.withWatermark("__event_time", watermark).dropDuplicatesWithinWatermark([key]).drop("__event_time")


def enrich_reference(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Stream-static left join to a dimension; AQE/stats decide broadcast vs shuffle.

    The static side is evaluated again for every micro-batch: pass a stored
    table (see ``materialize``), not a plan that recomputes upstream work.
    """
    return df.join(dim, on, "left")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table (a lineage cut)."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
