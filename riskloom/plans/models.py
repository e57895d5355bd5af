"""Model registry: saved versions with their hold-out rows, and one record of the current version per name.

Registering saves the model and its hold-out rows, then adds a row to the
manifest. Making a version current is a step of its own: the records of a
name are numbered folders, and the next number is taken by renaming a
prepared folder to it, which fails for all but one of several writers that
saw the same state. A reader sees the last record, always a whole one.

The store must rename folders atomically (local disks, HDFS). A plain object
store doesn't; there the record belongs in a table format with commits.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import NamedTuple

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import evaluation as evl
from riskloom.operators import ml
from riskloom.sources.files import list_files, store_path
from riskloom.sources.fixtures import run_ts_lit

ENTRY = ("model_name string, version string, model_path string, holdout_path string, run_id string, f1_score double, "
         "n_trees int, max_depth int, seed int, feature_snapshot date, created_at timestamp_ntz")
RECORD = "record.json"


class Current(NamedTuple):
    """The current version of a name; number 0 means there is none yet."""

    number: int
    version: str | None


class Conflict(RuntimeError):
    """Another writer made a version current since the state was read."""


class ModelMismatch(RuntimeError):
    """A loaded model doesn't score its hold-out rows as its manifest row says."""


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> DataFrame:
        """All registered versions."""
        files = [r.path for r in list_files(self.spark, f"{self.root}/manifest", "*.parquet").sort("path").collect()]
        return self.spark.read.schema(ENTRY).parquet(*files) if files else self.spark.createDataFrame([], ENTRY)

    def register(self, name: str, model, holdout: DataFrame, run_id: str, f1: float, snapshot: dt.date,
                 run_ts: dt.datetime) -> str:
        """Save a fitted pipeline with its hold-out rows; the new version (not yet current)."""
        version = uuid.uuid4().hex
        model_path, rows_path = f"{self.root}/models/{name}/{version}", f"{self.root}/holdout/{name}/{version}"
        model.write().save(model_path)
        holdout.write.parquet(rows_path)
        entry = self.spark.createDataFrame(
            [(name, version, model_path, rows_path, run_id, f1, ml.N_TREES, ml.MAX_DEPTH, ml.SEED, snapshot)],
            ", ".join(ENTRY.split(", ")[:-1])).withColumn("created_at", run_ts_lit(run_ts))
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return version

    def _records(self, name: str) -> tuple[pafs.FileSystem, str]:
        fs, path = store_path(f"{self.root}/current/{name}")
        fs.create_dir(path, recursive=True)
        return fs, path

    def current(self, name: str) -> Current:
        fs, path = self._records(name)
        numbers = [int(i.base_name) for i in fs.get_file_info(pafs.FileSelector(path)) if i.base_name.isdigit()]
        if not numbers:
            return Current(0, None)
        with fs.open_input_file(f"{path}/{max(numbers):08d}/{RECORD}") as f:
            return Current(max(numbers), json.loads(f.read())["version"])

    def make_current(self, name: str, version: str, seen: Current) -> Current:
        """Take the next record for ``version``, if the state is still the one ``seen``; else ``Conflict``."""
        if self.manifest().where((F.col("model_name") == name) & (F.col("version") == version)).isEmpty():
            raise ValueError(f"version {version} of {name} is not registered")
        fs, path = self._records(name)
        number, mine = seen.number + 1, uuid.uuid4().hex
        record = {"version": version, "record": mine, "after": seen.number}
        fs.create_dir(f"{path}/.{mine}")
        with fs.open_output_stream(f"{path}/.{mine}/{RECORD}") as f:
            f.write(json.dumps(record).encode())
        target = f"{path}/{number:08d}"
        try:
            fs.move(f"{path}/.{mine}", target)
        except OSError:
            fs.delete_dir(f"{path}/.{mine}")
        # Some stores move a folder into one that exists, instead of failing: whose record it is decides.
        with fs.open_input_file(f"{target}/{RECORD}") as f:
            if json.loads(f.read())["record"] != mine:
                raise Conflict(f"{name}: record {number} was taken by another writer")
        return Current(number, version)

    def load(self, name: str, version: str | None = None, check: bool = True):
        """(model, manifest row) of the current version, or a given one.

        With ``check`` the loaded model scores its stored hold-out rows, and
        its F1 must be that of the manifest row.
        """
        from pyspark.ml import PipelineModel

        version = version or self.current(name).version
        if version is None:
            raise ValueError(f"no current model {name}")
        entry = self.manifest().where((F.col("model_name") == name) & (F.col("version") == version)).first()
        model = PipelineModel.load(entry.model_path)
        if check:
            rows = ml.score(model, self.spark.read.parquet(entry.holdout_path)).select(ml.LABEL, "prediction", "score")
            f1 = evl.metrics(rows).first().f1_score
            if abs(f1 - entry.f1_score) > 1e-9:
                raise ModelMismatch(f"{name} {version}: F1 {f1} on its hold-out rows, {entry.f1_score} in the manifest")
        return model, entry
