"""Table statistics from footers, prefix sums over many ranges, validation in one pass."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from riskloom.functions.prefix import prefix_sums
from riskloom.operators import governance as gv
from riskloom.operators import quality as qa
from riskloom.session import shared_dir as shared_uri

SF = "/root/testdata/sf0.001"


def shared_dir(spark, name):
    """A local path: the tests look at the files themselves."""
    return shared_uri(spark, name).removeprefix("file:")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_stats_equal_the_file_system(spark):
    path = shared_dir(spark, "stats")
    spark.range(100).select("id", F.when(F.col("id") > 9, F.col("id") % 3).alias("p")).write.partitionBy("p").parquet(path)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    got = qa.table_stats(spark, {"t": path, "missing": path + "-none"})
    assert "Scan parquet" not in plan(got)  # listing and footers only
    row = got.collect()
    assert len(row) == 1
    assert (row[0].table_name, row[0].row_count, row[0].num_files) == ("t", 100, len(files))
    assert row[0].size_bytes == sum(map(os.path.getsize, files)) and row[0].num_partitions == 3
    newest = max(os.stat(f).st_mtime for f in files)
    seconds = got.select(F.unix_millis("last_modified").alias("ms")).first().ms / 1000
    assert abs(seconds - newest) < 1


def test_table_health_ties_and_sizes(spark):
    base, now = shared_dir(spark, "health"), 1_000_000_000
    catalogue = {}
    for name, rows, age in (("a", 5, 0), ("b", 9, 0), ("c", 9, 0), ("old", 99, 50)):
        path = f"{base}/{name}"
        spark.range(rows).coalesce(1).write.parquet(path)
        catalogue[name] = ("layer", path)
        for f in os.listdir(path):
            os.utime(f"{path}/{f}", (now - age, now - age))
    got = [(r.table_name, r.rank) for r in qa.table_health(spark, catalogue, top=3).orderBy("rank").collect()]
    assert got == [("b", 1), ("c", 2), ("a", 3)]


def test_column_stats_say_when_they_do_not_know(spark):
    path = shared_dir(spark, "columns")
    spark.createDataFrame([(1, "a", dt.datetime(1970, 1, 2)), (None, None, None)], "i int, s string, t timestamp_ntz").coalesce(
        1).write.parquet(path)
    spark.createDataFrame([(None, "b", None)], "i int, s string, t timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    got = {r.column: (r.n_values, r.n_nulls, r.low, r.high) for r in qa.column_stats(spark, {"t": path}).collect()}
    assert got == {"i": (3, 2, 1.0, 1.0), "s": (3, 1, None, None), "t": (3, 2, 86400.0, 86400.0)}


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("rows_per_range", [7, 1000])
def test_prefix_sums_over_ranges(spark, inclusive, rows_per_range):
    rows = [(g, i * 0.5, i % 4) for g, n in (("a", 90), ("b", 1), ("c", 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, x double, v long").repartition(5)
    got = prefix_sums(df, ["g"], "x", ["v"], inclusive, rows_per_range).collect()
    assert len(got) == len(rows)
    for r in got:
        below = [v for g, x, v in rows if g == r.g and (x <= r.x if inclusive else x < r.x)]
        assert r.cum_v == sum(below) and r.total_v == sum(v for g, _, v in rows if g == r.g)
    flat = prefix_sums(df.where("g = 'a'"), [], "x", ["v"], inclusive, rows_per_range)
    assert max(r.total_v for r in flat.collect()) == sum(v for g, _, v in rows if g == "a")
    assert prefix_sums(df.where("g = 'z'"), ["g"], "x", ["v"]).count() == 0


def test_drift_reads_its_counts_twice_only(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(gv.drift_ks(li.where("l_linenumber < 4"), li.where("l_linenumber >= 4"), ["l_quantity", "l_tax"]))
    assert text.count("FileScan parquet") == 2


RULES = {"id": "int", "name": "string", "when": "date", "gone": "string", "odd": "uuid"}


def test_validation_is_one_scan(spark):
    path = shared_dir(spark, "validate")
    spark.createDataFrame([("1", "a", "2001-01-01", 1, "u"), ("x", None, "5", 2, "u"), ("y", "", None, 3, "u")],
                          "id string, name string, when string, extra long, odd string").write.parquet(path)
    report = qa.validate_dataset(spark.read.parquet(path), RULES, ["id", "name"], max_null_rate=0.5)
    assert plan(report).count("FileScan parquet") == 1
    got = {(r.check, r.column): (r.severity, r.value, r.detail) for r in report.collect()}
    assert got == {
        ("schema_missing", "gone"): ("error", None, "Missing required column"),
        ("schema_extra", "extra"): ("warning", None, "Unexpected column (will be ignored)"),
        ("null_rate", "id"): ("info", 0.0, "null_count=0 rows=3"),
        ("null_rate", "name"): ("error", 2 / 3, "null_count=2 rows=3"),
        ("type", "id"): ("error", 2.0, "Column 'id' expected type 'int', got value x"),
        ("type", "when"): ("error", 1.0, "Column 'when' expected type 'date', got value 5"),
        ("type", "odd"): ("error", 0.0, "Unknown expected type 'uuid' for column 'odd'"),
        ("verdict", None): ("error", 5.0, "invalid")}
    assert qa.validate_dataset(spark.read.parquet(path), RULES, ["id"], sample_rows=1).where("check = 'null_rate'").first(
    ).detail == "null_count=0 rows=1"


def test_validation_of_an_empty_file(spark):
    df = spark.createDataFrame([], "id long")
    got = {r.check: r.severity for r in qa.validate_dataset(df, {"id": "int"}, ["id"]).collect()}
    assert got == {"null_rate": "info", "empty": "error", "verdict": "error"}
