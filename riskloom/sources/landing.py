"""Readers for landed files and partition-aware table reads."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.streaming.runner import materialize

# Formats accepted in the landing zone.
SUPPORTED_FORMATS = (".csv", ".json", ".jsonl", ".parquet")


def format_of(path: str) -> str:
    """File suffix of a landing path; rejects anything outside the whitelist."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported file format: {suffix or '(none)'}; expected one of {SUPPORTED_FORMATS}")
    return suffix.lstrip(".")


def read_landing(spark: SparkSession, path: str, fmt: str | None = None,
                 schema: StructType | None = None, max_rows: int | None = None,
                 glob: str | None = None) -> DataFrame:
    """Read landed files of one format below ``path`` (recursive).

    ``fmt`` is one of parquet / csv / jsonl (one JSON object per line) /
    json (a document: an array gives many rows, an object one row). A
    declared ``schema`` avoids inference passes; CSV keeps surrounding
    blanks and the empty string as written. ``max_rows`` is the optional
    head sample (pushed into the scan as a limit).
    """
    fmt = (fmt or format_of(path)).lower().lstrip(".")
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "parquet":
        df = r.parquet(path)
    elif fmt == "csv":
        df = (r.option("header", "true").option("mode", "PERMISSIVE")
              .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
              .option("emptyValue", "").csv(path))
    elif fmt == "jsonl":
        df = r.option("mode", "PERMISSIVE").json(path)
    elif fmt == "json":
        df = r.option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    else:
        raise ValueError(f"Unsupported file format: {fmt}")
    return df.limit(max_rows) if max_rows else df


def read_landing_checked(spark: SparkSession, path: str, fmt: str, schema: StructType,
                         corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of CSV or JSON files read with a declared schema.

    A reject is the raw text of a record that doesn't fit the schema (bad
    value, missing or surplus field). Good rows and rejects together are all
    records.
    """
    if fmt not in ("csv", "jsonl", "json"):
        raise ValueError(f"{fmt} has no corrupt records")
    wide = StructType([*schema.fields, StructField(corrupt_col, StringType())])
    r = (spark.read.option("recursiveFileLookup", "true").schema(wide).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", corrupt_col))
    if fmt == "csv":
        # Surplus and missing fields are seen only if the parser reads every column.
        df = r.option("header", "true").option("enforceSchema", "true").option("emptyValue", "").csv(path)
    else:
        df = r.option("multiLine", str(fmt == "json").lower()).json(path)
    # Parsed once into a stored table: a plan that prunes columns would not see faults in the others.
    parsed = materialize(df, "landing-checked")
    bad = F.col(corrupt_col).isNotNull()
    return parsed.where(~bad).drop(corrupt_col), parsed.where(bad).select(corrupt_col)


def raw_view(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """External-table equivalent: a temp view over the landed files."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def partition_filter(df: DataFrame, date_col: str, start: dt.date, end: dt.date,
                     columns: Sequence[str] | None = None, extra: Column | str | None = None) -> DataFrame:
    """Inclusive date-range read with optional column list and extra predicate.

    Unknown columns are rejected up front; on a table partitioned by
    ``date_col`` the range becomes a partition filter at the scan.
    """
    if columns:
        unknown = [c for c in columns if c not in df.columns]
        if unknown:
            raise ValueError(f"Invalid column selection: {unknown}")
    if date_col not in df.columns:
        raise ValueError(f"Invalid date column: {date_col}")
    out = df.where(F.col(date_col).between(F.lit(start), F.lit(end)))
    if extra is not None:
        out = out.where(F.expr(extra) if isinstance(extra, str) else extra)
    return out.select(*columns) if columns else out
