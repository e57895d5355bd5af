"""Table sinks: write dispositions, partitioned + clustered layout, exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

# Write dispositions and their Spark save modes.
DISPOSITIONS = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append", "WRITE_EMPTY": "empty",
                "REPLACE_PARTITIONS": "partitions",
                "overwrite": "overwrite", "append": "append", "empty": "empty", "partitions": "partitions"}


def _has_data(spark: SparkSession, path: str, fmt: str) -> bool:
    """Whether a table has rows; a path that doesn't exist (or has no files) has none, any other error is raised."""
    try:
        return not spark.read.format(fmt).load(path).isEmpty()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = (), schema: StructType | None = None,
                fmt: str = "parquet", max_records_per_file: int = 5_000_000,
                derived: Mapping[str, Column] | None = None) -> str:
    """Write with a disposition: overwrite (truncate) / append / empty (fail if data exists) / partitions.

    Truncate replaces the whole table, whatever the session's overwrite mode;
    ``partitions`` replaces only the partitions that df has.

    Partitioned writes use the REBALANCE hint on the partition columns: one
    hash shuffle whose oversized partitions (a hot date) AQE splits at
    runtime into advisory-size pieces and whose small ones it coalesces, so
    a date with a third of the rows is written by many tasks and no
    sampling job re-runs the upstream plan (as range partitioning would).
    Rows are sorted by (partition, cluster) columns inside each task, so
    files are clustered and row-group min/max prune on the cluster keys.
    Columns that follow from others of their row (``derived``: name and
    expression) are not shuffled or sorted but computed as rows are written,
    unless the table is partitioned or clustered by them.
    """
    save_mode = DISPOSITIONS.get(mode)
    if save_mode is None:
        raise ValueError(f"unknown write disposition {mode!r}")
    spark = df.sparkSession
    dynamic = save_mode == "partitions"
    if dynamic:
        if not partition_by:
            raise ValueError("REPLACE_PARTITIONS needs partition columns")
        save_mode = "overwrite"
    if save_mode == "empty":
        if _has_data(spark, path, fmt):
            raise ValueError(f"destination {path} is not empty (WRITE_EMPTY)")
        save_mode = "append"
    out = df.to(schema) if schema is not None else df
    keys, columns = [*partition_by, *cluster_by], out.columns
    derived = {name: c for name, c in (derived or {}).items() if name not in keys}
    out = out.drop(*derived)
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    elif cluster_by:
        out = out.hint("rebalance")
    if keys:
        out = out.sortWithinPartitions(*keys)
    if derived:
        out = out.withColumns(derived).select(*columns)
    w = out.write.mode(save_mode).format(fmt).option("maxRecordsPerFile", max_records_per_file)
    if fmt == "parquet":
        w = w.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    w.save(path)
    return path


def export_offline(df: DataFrame, path: str) -> str:
    """Feature snapshot export as Parquet."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_predictions(df: DataFrame, path: str, fmt: str = "jsonl") -> str:
    """Prediction output; JSON Lines by default."""
    if fmt in ("jsonl", "json"):
        df.write.mode("overwrite").json(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    """Report rows (one row per check) as JSON Lines."""
    df.write.mode("overwrite").json(path)
    return path
