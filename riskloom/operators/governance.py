"""Governance: deletion, PII-free projection, expiry, policy views, drift."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.prefix import prefix_sums
from riskloom.sources.files import remove_folders
from riskloom.sources.upsert import partition_folders, same_parts

# Fixed value: drift alert level.
DRIFT_ALPHA = 0.05


def delete_entities(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in the deletion list (anti join; the list is a DataFrame)."""
    return df.join(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def rewrite_without(df: DataFrame, ids: DataFrame, key: str, path: str, partition_by: Sequence[str]) -> str:
    """Apply a deletion list to a partitioned table, rewriting only the touched partitions.

    The touched partitions are found by a semi join (no id list on the
    driver); dynamic partition overwrite replaces just those.
    """
    parts = list(partition_by)
    touched = df.join(ids.select(key).distinct(), key, "left_semi").select(*parts).distinct()
    # Null-safe: the partition of rows without a partition value is a partition too.
    keep = delete_entities(same_parts(df, touched, parts, "left_semi"), ids, key)
    # Partitions whose every row is deleted get no output rows, so dynamic overwrite would leave
    # them in place: list them (partition values only, bounded by the partition count) first.
    emptied = same_parts(touched, keep.select(*parts).distinct(), parts, "left_anti").collect()
    (keep.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))
    drop_partitions(df.sparkSession, path, parts, [tuple(r) for r in emptied])
    return path


def drop_partitions(spark, path: str, partition_by: Sequence[str], values: Sequence[tuple]) -> None:
    """Remove whole partition folders of a file table (like DROP PARTITION); NULL is a value."""
    table = spark.read.parquet(path)
    chosen = spark.createDataFrame([tuple(v) for v in values], table.select(*partition_by).schema)
    remove_folders(partition_folders(table, chosen, partition_by)).collect()
    spark.catalog.refreshByPath(path)


def pii_projection(df: DataFrame, allowed: Sequence[str], hash_ids: Sequence[str] = (), salt: str = "") -> DataFrame:
    """Allow-listed columns only; identifier columns replaced by SHA-256 hex of the salt and the value.

    Small integer ids can be found by trying all values: give a secret salt.
    """
    cols = []
    for c in allowed:
        if c in hash_ids:
            cols.append(F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def policy_view(df: DataFrame, role: str, policy: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns a role may read (a view, not authentication); unknown role -> error."""
    if role not in policy:
        raise PermissionError(f"role {role!r} has no access")
    allowed = policy[role]
    cols = df.columns if "*" in allowed else [c for c in df.columns if c in allowed]
    return df.select(*cols)


def expire(df: DataFrame, date_col: str, as_of: dt.date, days: int) -> DataFrame:
    """Rows still inside retention (date >= as_of - days)."""
    return df.where(F.col(date_col) >= F.date_sub(F.lit(as_of), days))


def apply_expiry(spark, path: str, date_col: str, as_of: dt.date, days: int) -> list:
    """Drop the partitions of a file table older than the retention window; returns their values.

    Only the partition column is read (directory metadata), and the list is
    bounded by the number of partitions, never by rows.
    """
    table = spark.read.parquet(path)
    old = (table.select(date_col).distinct()
           .where(F.col(date_col) < F.date_sub(F.lit(as_of), days)).collect())
    values = [(r[0],) for r in old]
    drop_partitions(spark, path, [date_col], values)
    return [v[0] for v in values]


def expiry_report(df: DataFrame, date_col: str, as_of: dt.date, days: int) -> DataFrame:
    """Per partition date: row count and whether retention drops it."""
    return (df.groupBy(date_col).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("expired", F.col(date_col) < F.date_sub(F.lit(as_of), days)))


def drift_ks(base: DataFrame, current: DataFrame, cols: Sequence[str], alpha: float = DRIFT_ALPHA,
             terms: int = 100) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and asymptotic p-value per feature.

    Exact statistic, computed without one task per feature: values are
    counted per (feature, value) (map-side combine, so a hot value is one
    row) and stored once; the two empirical CDFs are prefix sums over ranges
    as many as the counts need (``prefix_sums``), the statistic their largest gap.
    """
    def long(df: DataFrame, sample: int) -> DataFrame:
        arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
        return df.select(F.inline(arr)).where(F.col("value").isNotNull()).withColumn("sample", F.lit(sample))

    s = long(base, 1).unionByName(long(current, 2))
    counts = s.groupBy("feature", "value").agg(F.count_if(F.col("sample") == 1).alias("n1"),
                                               F.count_if(F.col("sample") == 2).alias("n2"))
    cdf = prefix_sums(counts, ["feature"], "value", ["n1", "n2"]).select(
        "feature", F.col("total_n1").alias("t1"), F.col("total_n2").alias("t2"),
        F.abs(F.col("cum_n1") / F.col("total_n1") - F.col("cum_n2") / F.col("total_n2")).alias("gap"))
    d = cdf.groupBy("feature").agg(F.max("gap").alias("ks"), F.first("t1").alias("n1"), F.first("t2").alias("n2"))
    en = F.sqrt(F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2")))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * F.col("ks")
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda acc, k: acc + F.lit(2.0) * F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
                         * F.exp(F.lit(-2.0) * k * k * lam * lam))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), series))
    return d.select("feature", F.col("n1").cast("long").alias("n_base"), F.col("n2").cast("long").alias("n_current"),
                    F.col("ks").alias("ks_statistic"), p.alias("p_value"), (p < F.lit(alpha)).alias("drift_alert"))
