"""Layer tables that several queries of a session read: built once, then read from the shared folder.

A table is known by the application, its name, and the files it is made of
(path, size and time of every source file), so another session, or changed
sources, build their own. A table whose files are gone is built again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_dir
from riskloom.sources.files import list_files

_TABLES: dict[tuple, str] = {}


def _state(spark: SparkSession, sources: Sequence[str]) -> int:
    """Hash of all files of the sources (one number comes to the driver)."""
    total = 0
    for s in sources:
        each = F.xxhash64("path", "n_bytes", "modified")
        total ^= list_files(spark, s).agg(F.coalesce(F.bit_xor(each), F.lit(0))).first()[0]
    return total


def stored_path(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[str], None]) -> str:
    """The folder that ``build(path)`` has filled for this session and these sources."""
    key = (spark.sparkContext.applicationId, name, *sources, _state(spark, sources))
    path = _TABLES.get(key)
    if path is None or list_files(spark, path).isEmpty():
        path = shared_dir(spark, name)
        build(path)
        _TABLES[key] = path
    return path


def stored(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[str], None]) -> DataFrame:
    """The table ``name``, which ``build(path)`` writes, as a stored table."""
    return spark.read.parquet(stored_path(spark, name, sources, build))
