"""Files of the shared store as DataFrames: listing, Parquet footers, removal.

Listing is Spark's own (no file is opened); footers and removals run in
tasks, a file or folder each, through ``pyarrow.fs``, so they work on a
local path, HDFS or an object store that library knows, and without the
driver's JVM gateway. Every step may be repeated by a retried task.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "path string, n_bytes bigint, modified timestamp"
FOOTER = ("path string, n_bytes bigint, modified timestamp, n_rows bigint, n_row_groups bigint, "
          "columns array<struct<name:string, n_values:bigint, n_nulls:bigint, low:double, high:double>>")


def store_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI as Spark writes it (``file:/x``) or of a plain path."""
    if uri.startswith("file:") or uri.startswith("/"):
        return pafs.LocalFileSystem(), "/" + unquote(uri.removeprefix("file:")).lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, n_bytes, modified) of all files below ``root``; a root that doesn't exist has none.

    Names that begin with ``_`` or ``.`` are no data and left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return files.select("path", F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"))


def _number(value) -> float | None:
    """A column's bound as a number: numbers as they are, times as seconds, others none."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return float(value)
    if hasattr(value, "toordinal"):
        import datetime as dt
        moment = value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())
        return (moment.replace(tzinfo=None) - dt.datetime(1970, 1, 1)).total_seconds()
    return None


def _columns(meta: pq.FileMetaData) -> list[dict]:
    """Values, nulls and bounds of every column; null where a row group doesn't state it."""
    out = []
    for c in range(meta.num_columns):
        chunks = [meta.row_group(g).column(c) for g in range(meta.num_row_groups)]
        stats = [k.statistics for k in chunks]
        known = all(s is not None and s.has_null_count for s in stats)
        nulls = sum(s.null_count for s in stats) if known else None
        bounds = [(_number(s.min), _number(s.max)) for s in stats if s is not None and s.has_min_max]
        # A row group of nulls alone has no bounds; any other without them leaves the column's unknown.
        whole = known and len(bounds) == sum(s.null_count < k.num_values for s, k in zip(stats, chunks))
        whole = whole and all(lo is not None for lo, _ in bounds)
        out.append({"name": chunks[0].path_in_schema if chunks else meta.schema.column(c).path,
                    "n_values": sum(k.num_values for k in chunks), "n_nulls": nulls,
                    "low": min(lo for lo, _ in bounds) if whole and bounds else None,
                    "high": max(hi for _, hi in bounds) if whole and bounds else None})
    return out


def parquet_footers(spark: SparkSession, root: str) -> DataFrame:
    """One row per Parquet file below ``root``: size, time, rows, row groups, column statistics; no row is read."""
    schema = pa.schema([("path", pa.string()), ("n_bytes", pa.int64()), ("modified", pa.timestamp("us", "UTC")),
                        ("n_rows", pa.int64()), ("n_row_groups", pa.int64()),
                        ("columns", pa.list_(pa.struct([("name", pa.string()), ("n_values", pa.int64()),
                                                        ("n_nulls", pa.int64()), ("low", pa.float64()),
                                                        ("high", pa.float64())])))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = store_path(row["path"])
                with fs.open_input_file(path) as f:
                    meta = pq.ParquetFile(f).metadata
                row |= {"n_rows": meta.num_rows, "n_row_groups": meta.num_row_groups, "columns": _columns(meta)}
                yield pa.RecordBatch.from_pylist([row], schema=schema)
    return list_files(spark, root, "*.parquet").mapInArrow(read, FOOTER)


def remove_folders(folders: DataFrame, column: str = "folder") -> DataFrame:
    """Deletes the folders named in a column; (folder, existed). One that is gone already is no fault."""
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = store_path(uri)
                existed = fs.get_file_info(path).type != pafs.FileType.NotFound
                if existed:
                    fs.delete_dir(path)
                yield pa.RecordBatch.from_pydict({"folder": [uri], "existed": [existed]})
    return folders.select(F.col(column).alias("folder")).mapInArrow(remove, "folder string, existed boolean")
