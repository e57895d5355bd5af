"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder as Parquet and read back."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column (one aggregate row), for size checks before a broadcast."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{column}`"))), F.lit(0))).first()[0]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; memory that a task has freed goes back to the system when it ends.

    Python workers stay for later tasks, and each would keep the most that any
    of its tasks has had, beside the executor's heap.
    """
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
            if trim:
                trim(0)
    return tidy
