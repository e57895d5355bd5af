"""Named SQL templates: text with parameter markers, run with tables and values, written with a disposition.

A template is a file ``<name>.sql``. ``IDENTIFIER(:name)`` stands for a table
and ``:name`` for a value; both are bound by Spark, so a value is never read
as SQL, whatever it holds. A template of the same name in a folder of one's
own, or given as text, takes the place of the library's.
"""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions import columns as fc
from riskloom.operators.features import DEFAULT_P50, DEFAULT_P90
from riskloom.sources.sinks import write_table

SQL_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "sql")


class UnknownTemplate(KeyError):
    """No template of that name in any place."""


class Templates:
    """Templates by name: given texts first, then the folders in order, then the library's."""

    def __init__(self, folders: Sequence[str] = (), texts: Mapping[str, str] | None = None):
        self.folders, self.texts = [*folders, SQL_DIR], dict(texts or {})

    def names(self) -> list[str]:
        found = set(self.texts)
        for folder in self.folders:
            found |= {f[:-4] for f in os.listdir(folder) if f.endswith(".sql")}
        return sorted(found)

    def text(self, name: str) -> str:
        if not re.fullmatch(r"\w+", name):
            raise UnknownTemplate(name)
        if name in self.texts:
            return self.texts[name]
        for folder in self.folders:
            path = os.path.join(folder, f"{name}.sql")
            if os.path.exists(path):
                with open(path, encoding="utf-8") as f:
                    return f.read()
        raise UnknownTemplate(name)

    def parameters(self, name: str) -> tuple[set[str], set[str]]:
        """(tables, values) that a template's text names."""
        text = re.sub(r"--[^\n]*", "", self.text(name))
        tables = set(re.findall(r"IDENTIFIER\(\s*:(\w+)\s*\)", text))
        return tables, set(re.findall(r"(?<![:\w]):(\w+)", text)) - tables

    def run(self, spark: SparkSession, name: str, tables: Mapping[str, str], values: Mapping[str, object] | None = None,
            destination: str | None = None, disposition: str = "WRITE_TRUNCATE", partition_by: Sequence[str] = (),
            cluster_by: Sequence[str] = ()) -> DataFrame:
        """The template's rows; with ``destination`` (a path) written there first, with that disposition, and read back.

        Tables and values that the template doesn't name are left aside, so
        one set serves a whole chain; one that is missing is an error.
        """
        want_tables, want_values = self.parameters(name)
        values = dict(values or {})
        missing = (want_tables - set(tables)) | (want_values - set(values))
        if missing:
            raise ValueError(f"template {name} lacks {sorted(missing)}")
        args = {k: tables[k] for k in want_tables} | {k: values[k] for k in want_values}
        rows = spark.sql(self.text(name), args=args)
        if destination is None:
            return rows
        write_table(rows, destination, disposition, partition_by=partition_by, cluster_by=cluster_by)
        return spark.read.parquet(destination)


def chain_values(as_of: dt.date, run_ts: dt.datetime, run_id: str) -> dict[str, object]:
    """Values of the library's templates; every one may be overridden."""
    w = fc.RISK_WEIGHTS
    return {"as_of": as_of, "run_ts": run_ts.strftime("%Y-%m-%d %H:%M:%S"), "run_id": run_id, "days": 90,
            "default_p50": DEFAULT_P50, "default_p90": DEFAULT_P90, "flag_acceleration": fc.FLAG_ACCELERATION,
            "flag_late": fc.FLAG_LATE, "w_late": w["late"], "w_stockout": w["stockout"], "w_coverage": w["coverage"],
            "w_variability": w["variability"], "high": fc.HIGH_BAND, "medium": fc.MEDIUM_BAND}


# The chain's templates, the table each makes, its partition and cluster columns.
CHAIN = (("staging_inventory", "staging", ("ingestion_date",), ("sku_id", "vendor_id")),
         ("demand_signals", "signals", ("signal_date",), ("sku_id",)),
         ("sku_risk_features", "features", ("feature_date",), ("sku_id", "vendor_id")),
         ("delay_risk_scores", "scores", ("score_date",), ()))


def run_chain(spark: SparkSession, raw: DataFrame, orders: DataFrame, out_dir: str, values: Mapping[str, object],
              templates: Templates | None = None) -> dict[str, DataFrame]:
    """The chain raw -> staging -> signals -> features -> scores from templates, each step a written table."""
    templates, made = templates or Templates(), {}
    views = {"raw": raw, "orders": orders}
    tag = re.sub(r"\W", "_", out_dir)[-24:]
    tables = {}
    for name, df in views.items():
        tables[name] = f"template_{name}_{tag}"
        df.createOrReplaceTempView(tables[name])
    for template, name, part, cluster in CHAIN:
        made[name] = templates.run(spark, template, tables, values, f"{out_dir}/{name}", partition_by=part, cluster_by=cluster)
        tables[name] = f"template_{name}_{tag}"
        made[name].createOrReplaceTempView(tables[name])
    for view in tables.values():
        spark.catalog.dropTempView(view)
    return made
