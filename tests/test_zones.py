"""The landing store: what the manifest says against the files, repeated and lost actions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from riskloom.session import shared_dir as shared_uri
from riskloom.sources import zones as zn
from riskloom.sources.files import list_files, parquet_footers

TS = dt.datetime(2001, 8, 1, 6)


def shared_dir(spark, name):
    """A local path: the tests look at the files themselves."""
    return shared_uri(spark, name).removeprefix("file:")


def batch(spark, days=4, copies=10):
    rows = [(i, dt.date(2001, 1, 1 + i % days), f"v{i}") for i in range(days * copies)]
    return spark.createDataFrame([*rows, (-1, None, "undated")], "id long, day date, v string")


def store(spark, **options):
    root = shared_dir(spark, "zones")
    zn.land(batch(spark), root, "erp", "day", "run", TS, **options)
    return root


def counts(spark, root, zone):
    rows = zn.read_entries(spark, root, zn.current(spark, root, zone))
    return {r.entry_path: r["count"] for r in rows.groupBy("entry_path").count().collect()} if "id" in rows.columns else {}


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_land_names_the_files_it_wrote(spark):
    root = store(spark)
    m = zn.current(spark, root).collect()
    assert {r.path: r.record_count for r in m} == {
        **{f"raw/prod/erp/2001-01-0{d}/data.parquet": 10 for d in range(1, 5)}, "raw/prod/erp/undated/data.parquet": 1}
    for r in m:
        assert r.n_bytes == sum(os.path.getsize(f"{root}/{f}") for f in r.files)
    zn.land(batch(spark, days=1, copies=3), root, "erp", "day", "run", TS + dt.timedelta(hours=1))  # the first day again
    assert counts(spark, root, "raw")["raw/prod/erp/2001-01-01/data.parquet"] == 3
    with pytest.raises(ValueError):
        zn.land(batch(spark), root, "../erp", "day", "run", TS)
    assert zn.land(batch(spark).where("id < -5"), root, "other", "day", "run", TS).count() == 0


def test_promote_is_repeatable_and_keeps_raw(spark):
    root = store(spark)
    one, two = "raw/prod/erp/2001-01-01/data.parquet", "raw/prod/erp/undated/data.parquet"
    first = zn.promote(spark, root, paths(spark, one, two, "staging/x", "raw/none"), TS).collect()
    assert {r.source_path: r.processing_status for r in first} == {
        one: "success", two: "success", "staging/x": "rejected: expected path under raw/",
        "raw/none": "rejected: source not found"}
    n_files = list_files(spark, root).count()
    again = zn.promote(spark, root, paths(spark, one, two, "staging/x", "raw/none"), TS + dt.timedelta(days=1)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, first)) and list_files(spark, root).count() == n_files
    assert counts(spark, root, "processed") == {one.replace("raw", "processed"): 10, two.replace("raw", "processed"): 1}
    assert len(counts(spark, root, "raw")) == 5
    assert [r.path for r in zn.unprocessed(spark, root).collect()] == [
        f"raw/prod/erp/2001-01-0{d}/data.parquet" for d in (2, 3, 4)]


def test_a_copy_that_differs_never_enters_the_manifest(spark, monkeypatch):
    root = store(spark)
    whole = zn._written
    monkeypatch.setattr(zn, "_written", lambda *a: whole(*a).withColumn("record_count", F.col("record_count") - 1))
    before = zn.read_manifest(spark, root).count()
    with pytest.raises(zn.CopyError):
        zn.archive(spark, root, paths(spark, "raw/prod/erp/2001-01-01/data.parquet"), TS)
    assert zn.read_manifest(spark, root).count() == before and len(counts(spark, root, "raw")) == 5
    monkeypatch.undo()
    assert zn.orphans(spark, root).count() > 0  # what the lost attempt wrote: nobody reads it
    assert counts(spark, root, "archive") == {}


def test_archive_moves_and_finishes_what_a_lost_driver_left(spark, monkeypatch):
    root = store(spark)
    one = "raw/prod/erp/2001-01-02/data.parquet"
    location = zn.current(spark, root).where(F.col("path") == one).first().location
    monkeypatch.setattr(zn, "remove_files", lambda *a: 0)  # the driver is lost after its append
    got = zn.archive(spark, root, paths(spark, one), TS).first()
    assert got.record_count == 10 and not got.source_deleted and os.path.exists(f"{root}/{location}")
    assert one not in counts(spark, root, "raw")  # the manifest has moved it all the same
    monkeypatch.undo()
    for hours in (1, 2):
        got = zn.archive(spark, root, paths(spark, one), TS + dt.timedelta(hours=hours)).first()
        assert (got.path, got.archived_timestamp, got.source_deleted) == ("archive/prod/erp/2001-01-02/data.parquet", TS, True)
    assert not os.path.exists(f"{root}/{location}")
    assert counts(spark, root, "archive") == {got.path: 10} and len(counts(spark, root, "raw")) == 4
    none = zn.archive(spark, root, paths(spark, "raw/none"), TS).first()
    assert none.path is None and not none.source_deleted


def test_footers_hold_counts_and_bounds(spark):
    path = shared_dir(spark, "footers")
    df = spark.createDataFrame([(1, 2.5, "a", dt.date(1970, 1, 3)), (None, None, None, None), (7, -1.0, "b", None)],
                               "i long, x double, s string, d date")
    df.coalesce(1).write.parquet(path)
    f = parquet_footers(spark, path).first()
    assert f.n_rows == 3 and f.n_bytes == os.path.getsize(f.path.removeprefix("file:"))
    got = {c.name: (c.n_values, c.n_nulls, c.low, c.high) for c in f.columns}
    assert got == {"i": (3, 1, 1.0, 7.0), "x": (3, 1, -1.0, 2.5), "s": (3, 1, None, None), "d": (3, 2, 172800.0, 172800.0)}
    assert parquet_footers(spark, path + "-none").count() == 0
