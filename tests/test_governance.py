import datetime as dt

from pyspark.sql import functions as F

from riskloom.operators import governance as gv
from riskloom.session import shared_dir
from riskloom.sources import manifest as mf


def _orders(spark):
    rows = [(1, 10, dt.date(2001, 1, 1)), (2, 11, dt.date(2001, 1, 1)), (3, 10, dt.date(2001, 2, 1)),
            (4, 12, dt.date(2001, 3, 1))]
    return spark.createDataFrame(rows, "o_orderkey long, o_custkey long, landing_date date")


def test_rewrite_without_touches_only_affected_partitions(spark):
    path = shared_dir(spark, "gdpr")
    _orders(spark).write.partitionBy("landing_date").parquet(path)
    table = spark.read.parquet(path)
    ids = spark.createDataFrame([(10,)], "o_custkey long")
    gv.rewrite_without(table, ids, "o_custkey", path, ["landing_date"])
    back = {r.o_orderkey for r in spark.read.parquet(path).collect()}
    assert back == {2, 4}          # March partition untouched, customer 10 gone everywhere


def test_expire_keeps_window(spark):
    df = _orders(spark)
    kept = gv.expire(df, "landing_date", dt.date(2001, 3, 1), 30)
    assert {r.o_orderkey for r in kept.collect()} == {3, 4}
    rep = {r.landing_date: r.expired for r in gv.expiry_report(df, "landing_date", dt.date(2001, 3, 1), 30).collect()}
    assert rep[dt.date(2001, 1, 1)] is True and rep[dt.date(2001, 3, 1)] is False


def test_pii_projection_hashes_ids(spark):
    df = spark.createDataFrame([(7, "Alice", 1.0)], "c_custkey long, c_name string, c_acctbal double")
    out = gv.pii_projection(df, ["c_custkey", "c_acctbal"], ["c_custkey"]).first()
    assert len(out.c_custkey) == 64 and "c_name" not in out.asDict()


def test_promote_rejects_non_raw(spark):
    m = spark.createDataFrame([("raw/p/s/2001-01-01/a.parquet", 3)], "path string, record_count long")
    req = spark.createDataFrame([("raw/p/s/2001-01-01/a.parquet",), ("staging/x.parquet",), ("raw/missing",)],
                                "path string")
    st = {r.source_path: r.processing_status for r in mf.promote_files(m, req, dt.datetime(2001, 8, 1)).collect()}
    assert st["raw/p/s/2001-01-01/a.parquet"] == "success"
    assert st["staging/x.parquet"].startswith("rejected") and st["raw/missing"].startswith("rejected")
    arch = mf.archive_files(m.withColumn("path", F.lit("processed/p/s/a.parquet")),
                            spark.createDataFrame([("processed/p/s/a.parquet",)], "path string"),
                            dt.datetime(2001, 8, 1)).first()
    assert arch.path == "archive/p/s/a.parquet" and arch.source_deleted


def test_apply_expiry_drops_old_partitions(spark):
    path = shared_dir(spark, "expiry")
    _orders(spark).write.partitionBy("landing_date").parquet(path)
    dropped = gv.apply_expiry(spark, path, "landing_date", dt.date(2001, 3, 1), 30)
    assert dropped == [dt.date(2001, 1, 1)]
    assert {r.o_orderkey for r in spark.read.parquet(path).collect()} == {3, 4}
