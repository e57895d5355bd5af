"""Data-quality checks as one-pass aggregations returning long-format report rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.files import parquet_footers

# Quality gates.
MAX_NULL_RATE = 0.05
MIN_COMPLETENESS = 0.95
TYPE_NAMES = ("string", "int", "float", "date", "timestamp", "bool")


def _missing(df: DataFrame, c: str) -> Column:
    """Missing = SQL NULL, or the empty string on string columns (never NaN confusion)."""
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, T.StringType):
        return col.isNull() | (col == "")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _stack(df_one_row: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column") -> DataFrame:
    """Wide one-row aggregate -> one row per column name (via a struct array explode)."""
    arr = F.array(*[F.struct(F.lit(n).alias(key), *[F.col(f"{n}__{f}").alias(f) for f in fields])
                    for n in names])
    return df_one_row.select(F.inline(arr))


def completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: null_count, row_count, null_rate, completeness — one scan for all columns."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        aggs.append(F.count_if(_missing(df, c)).alias(f"{c}__null_count"))
    wide = df.agg(*aggs)
    for c in cols:
        wide = wide.withColumn(f"{c}__row_count", F.col("__n"))
    long = _stack(wide, cols, ["null_count", "row_count"])
    rate = F.try_divide(F.col("null_count").cast("double"), F.col("row_count").cast("double"))
    return long.select("column", F.col("null_count").cast("long").alias("null_count"),
                       F.col("row_count").cast("long").alias("row_count"),
                       F.coalesce(rate, F.lit(0.0)).alias("null_rate"),
                       (F.lit(1.0) - F.coalesce(rate, F.lit(0.0))).alias("completeness"))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: mean, sample std, min, max, non-null count (one scan)."""
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.count(x).alias(f"{c}__count")]
    return _stack(df.agg(*aggs), cols, ["mean", "std", "min", "max", "count"])


REQUIRED_FEATURES = ("sku_id", "demand_7d", "demand_30d", "lead_time_p90", "days_of_supply",
                     "stockout_flag", "delay_risk_score")
NUMERIC_FEATURES = ("demand_7d", "demand_30d", "lead_time_p90", "delay_risk_score")


def validate_features(df: DataFrame, required: Sequence[str] = REQUIRED_FEATURES,
                      numeric: Sequence[str] = NUMERIC_FEATURES,
                      min_completeness: float = MIN_COMPLETENESS) -> DataFrame:
    """Feature-table report: (check, column, metric, value, passed) + one verdict row."""
    spark = df.sparkSession
    present = [c for c in required if c in df.columns]
    missing = [c for c in required if c not in df.columns]
    comp = completeness(df, present).select(
        F.lit("completeness").alias("check"), "column", F.lit("completeness").alias("metric"),
        F.round("completeness", 4).alias("value"),
        (F.col("completeness") >= F.lit(min_completeness)).alias("passed"))
    num = [c for c in numeric if c in df.columns]
    prof = profile(df, num)
    dist = prof.select(F.lit("distribution").alias("check"), "column", F.inline(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.round(F.col(m), 4).alias("value")) for m in ("mean", "std", "min", "max")])),
        F.lit(True).alias("passed")).select("check", "column", "metric", "value", "passed")
    schema = "check string, column string, metric string, value double, passed boolean"
    miss = spark.createDataFrame([("required_column", c, "present", 0.0, False) for c in missing], schema)
    rows = comp.unionByName(dist).unionByName(miss)
    rowcount = df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("row_count").alias("check"), F.lit(None).cast("string").alias("column"),
        F.lit("rows").alias("metric"), "value", (F.col("value") > 0).alias("passed"))
    rows = rows.unionByName(rowcount)
    verdict = rows.agg(F.bool_and("passed").alias("passed")).select(
        F.lit("verdict").alias("check"), F.lit(None).cast("string").alias("column"),
        F.lit("passed").alias("metric"), F.col("passed").cast("double").alias("value"), "passed")
    return rows.unionByName(verdict)


def row_count_check(df: DataFrame, minimum: int = 1) -> DataFrame:
    """(row_count, minimum, passed) — the non-empty-output gate."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(minimum).cast("long").alias("minimum"),
        (F.col("row_count") >= minimum).alias("passed"))


def _type_ok(df: DataFrame, c: str, expected: str) -> Column:
    """True when a present value fits ``expected`` (strings are parsed leniently)."""
    dtype = df.schema[c].dataType
    col = F.col(f"`{c}`")
    s = col.cast("string")
    if expected == "string":
        return F.lit(isinstance(dtype, T.StringType))
    if expected == "int":
        if isinstance(dtype, T.BooleanType):
            return F.lit(False)
        if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            return F.lit(True)
        if isinstance(dtype, T.StringType):
            return s.try_cast("long").isNotNull()
        return F.lit(False)
    if expected == "float":
        if isinstance(dtype, T.BooleanType):
            return F.lit(False)
        if isinstance(dtype, T.NumericType):
            return F.lit(True)
        if isinstance(dtype, T.StringType):
            return s.try_cast("double").isNotNull()
        return F.lit(False)
    if expected == "date":
        if isinstance(dtype, T.DateType):
            return F.lit(True)
        return F.lit(isinstance(dtype, T.StringType)) & (F.length(s) >= 8)
    if expected == "timestamp":
        return F.lit(isinstance(dtype, (T.StringType, T.TimestampType, T.TimestampNTZType)))
    if expected == "bool":
        if isinstance(dtype, T.BooleanType):
            return F.lit(True)
        if isinstance(dtype, T.StringType):
            return F.lower(s).isin("true", "false")
        return F.lit(False)
    raise ValueError(expected)


def type_check(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column: checked (present values), bad_count, first_bad_value (smallest as text).

    One scan for all columns; unknown type names come back as an error row.
    """
    cols = [c for c in types if c in df.columns]
    aggs = [F.lit(0).alias("__z")]
    for c in cols:
        exp = types[c]
        if exp not in TYPE_NAMES:
            continue
        present = ~_missing(df, c)
        bad = present & ~_type_ok(df, c, exp)
        aggs += [F.count_if(present).alias(f"{c}__checked"), F.count_if(bad).alias(f"{c}__bad_count"),
                 F.min(F.when(bad, F.col(f"`{c}`").cast("string"))).alias(f"{c}__first_bad_value")]
    known = [c for c in cols if types[c] in TYPE_NAMES]
    spark = df.sparkSession
    out_schema = "column string, expected_type string, checked bigint, bad_count bigint, first_bad_value string, error string"
    if known:
        long = _stack(df.agg(*aggs), known, ["checked", "bad_count", "first_bad_value"])
        tmap = F.create_map(*[x for c in known for x in (F.lit(c), F.lit(types[c]))])
        res = long.select(
            "column", tmap[F.col("column")].alias("expected_type"),
            F.col("checked").cast("long").alias("checked"), F.col("bad_count").cast("long").alias("bad_count"),
            "first_bad_value",
            F.when(F.col("bad_count") > 0, F.concat(
                F.lit("Column '"), F.col("column"), F.lit("' expected type '"), tmap[F.col("column")],
                F.lit("', got value "), F.col("first_bad_value"))).alias("error"))
    else:
        res = spark.createDataFrame([], out_schema)
    unknown = [(c, types[c], 0, 0, None, f"Unknown expected type '{types[c]}' for column '{c}'")
               for c in cols if types[c] not in TYPE_NAMES]
    if unknown:
        res = res.unionByName(spark.createDataFrame(unknown, out_schema))
    return res


def schema_diff(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Declared vs actual columns: missing -> error, extra -> warning (schema only, no scan)."""
    spark = df.sparkSession
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for c, t in columns.items():
        rows.append((c, t, actual.get(c), "ok" if c in actual else "missing",
                     "info" if c in actual else "error"))
    for c, t in actual.items():
        if c not in columns:
            rows.append((c, None, t, "extra", "warning"))
    return spark.createDataFrame(rows, "column string, expected_type string, actual_type string, "
                                       "status string, severity string")


def validate_dataset(df: DataFrame, columns: Mapping[str, str], required: Sequence[str],
                     max_null_rate: float = MAX_NULL_RATE, sample_rows: int | None = None) -> DataFrame:
    """Validation report rows (check, column, severity, value, detail) plus a verdict row.

    The full dataset is validated in one aggregation pass: one row that
    carries the row count and, for every column, its null, value and
    mismatch counts is unpivoted to the report (``sample_rows`` restores the
    optional head sample). Missing columns are errors, extra columns
    warnings, null rate above the threshold and type mismatches errors (one
    error per column, showing the smallest offending value).
    """
    data = df.limit(sample_rows) if sample_rows else df
    have = set(data.columns)
    required = [c for c in required if c in have]
    typed = {c: t for c, t in columns.items() if c in have}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(required):
        aggs.append(F.count_if(_missing(data, c)).alias(f"nulls_{i}"))
    for i, (c, t) in enumerate(typed.items()):
        if t in TYPE_NAMES:
            bad = ~_missing(data, c) & ~_type_ok(data, c, t)
            aggs += [F.count_if(bad).alias(f"bad_{i}"), F.min(F.when(bad, F.col(f"`{c}`").cast("string"))).alias(f"first_{i}")]
    none, n = F.lit(None), F.col("n")

    def line(check: str, column: str | None, severity: Column, value: Column, detail: Column, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                                     severity.alias("severity"), value.cast("double").alias("value"), detail.alias("detail")))
    always, lines = F.lit(True), []
    for c in columns:
        if c not in have:
            lines.append(line("schema_missing", c, F.lit("error"), none, F.lit("Missing required column"), always))
    for c in data.columns:
        if c not in columns:
            lines.append(line("schema_extra", c, F.lit("warning"), none, F.lit("Unexpected column (will be ignored)"), always))
    for i, c in enumerate(required):
        nulls = F.col(f"nulls_{i}")
        rate = F.coalesce(F.try_divide(nulls.cast("double"), n.cast("double")), F.lit(0.0))
        lines.append(line("null_rate", c, F.when(rate > max_null_rate, F.lit("error")).otherwise(F.lit("info")), rate,
                          F.concat(F.lit("null_count="), nulls.cast("string"), F.lit(" rows="), n.cast("string")), always))
    lines.append(line("empty", None, F.lit("error"), F.lit(0.0), F.lit("File contains no records"), n == 0))
    for i, (c, t) in enumerate(typed.items()):
        if t in TYPE_NAMES:
            text = F.concat(F.lit(f"Column '{c}' expected type '{t}', got value "), F.col(f"first_{i}"))
            lines.append(line("type", c, F.lit("error"), F.col(f"bad_{i}"), text, F.col(f"bad_{i}") > 0))
        else:
            lines.append(line("type", c, F.lit("error"), F.lit(0.0), F.lit(f"Unknown expected type '{t}' for column '{c}'"), always))
    found = F.array_compact(F.array(*lines))
    errors = F.size(F.filter(found, lambda r: r["severity"] == "error"))
    verdict = F.struct(F.lit("verdict").alias("check"), none.cast("string").alias("column"),
                       F.when(errors == 0, F.lit("info")).otherwise(F.lit("error")).alias("severity"),
                       errors.cast("double").alias("value"),
                       F.when(errors == 0, F.lit("valid")).otherwise(F.lit("invalid")).alias("detail"))
    return data.agg(*aggs).select(F.inline(F.array_append(found, verdict)))


# A partition folder's part of a path, column=value; files outside one have none.
_PARTITION = r"((?:/[^/=]+=[^/]*)+)/[^/]+$"


def footer_stats(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table_name, path, n_bytes, modified, n_rows, columns) of every file of the tables (name -> path).

    Listing and Parquet footers only: no row is read.
    """
    out = None
    for name, path in tables.items():
        files = parquet_footers(spark, path).select(F.lit(name).alias("table_name"), "*")
        out = files if out is None else out.unionByName(files)
    return out


def table_stats(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Rows, files, bytes, last modified and partition count of Parquet tables (name -> path), from their footers.

    num_partitions counts the folders ``column=value`` with a value; a table
    without such folders has 0. A table that doesn't exist has no row.
    """
    folder = F.nullif(F.regexp_extract("path", _PARTITION, 1), F.lit(""))
    counted = F.when(~folder.contains("__HIVE_DEFAULT_PARTITION__"), folder)
    return footer_stats(spark, tables).groupBy("table_name").agg(
        F.sum("n_rows").alias("row_count"), F.count(F.lit(1)).alias("num_files"), F.sum("n_bytes").alias("size_bytes"),
        F.max("modified").alias("last_modified"), F.count_distinct(counted).alias("num_partitions"))


def column_stats(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Per table and column: values, nulls, smallest and largest (numbers; times in seconds), from the footers.

    NULL where a file doesn't state a number, or the column has no bounds as
    numbers.
    """
    c = footer_stats(spark, tables).select("table_name", F.explode("columns").alias("c")).select("table_name", "c.*")
    known = F.count_if(F.col("low").isNull() & (F.col("n_values") > F.coalesce("n_nulls", F.lit(-1)))) == 0
    return c.groupBy("table_name", F.col("name").alias("column")).agg(
        F.sum("n_values").alias("n_values"),
        F.when(F.count("n_nulls") == F.count(F.lit(1)), F.sum("n_nulls")).alias("n_nulls"),
        F.when(known, F.min("low")).alias("low"), F.when(known, F.max("high")).alias("high"))


def table_health(spark: SparkSession, catalogue: Mapping[str, tuple[str, str]], top: int = 5) -> DataFrame:
    """Per layer, the ``top`` newest tables (ties: most rows, then name) with size in MB.

    ``catalogue``: table -> (layer, path). Footers and listing only.
    """
    stats = table_stats(spark, {name: path for name, (_, path) in catalogue.items()})
    layers = F.create_map(*[F.lit(x) for name, (layer, _) in catalogue.items() for x in (name, layer)])
    w = Window.partitionBy("layer").orderBy(F.col("last_modified").desc(), F.col("row_count").desc(),
                                            F.col("table_name").asc())
    return (stats.withColumn("layer", layers[F.col("table_name")])
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("layer", "table_name", "row_count", F.round(F.col("size_bytes") / F.lit(1024.0 * 1024.0), 2)
                    .alias("size_mb"), "last_modified", F.col("rank").cast("int")))
