"""Pipeline over a document corpus: five operators of riskloom.llm, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. ``run`` writes each stage's result as
Parquet to the shared folder and reads it again for the next, so a lost
executor never repeats more than one stage.

1. toxicity: documents that the grammar's model rejects go;
2. SimHash near-dedup: one document of each group of near copies stays;
3. suffix-array dedup: strings of 400 bytes that occur elsewhere are cut out;
4. benchmark decontamination: spans of benchmark windows are cut out;
5. BM25 packing: what is left, as token sequences (a row per piece).
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from riskloom.llm import toxicity  # noqa: E402
from riskloom.llm.bm25_packing import pack  # noqa: E402
from riskloom.llm.decontaminate import decontaminate  # noqa: E402
from riskloom.llm.frames import table, written  # noqa: E402
from riskloom.llm.queries import vocabulary  # noqa: E402
from riskloom.llm.simhash import deduplicate  # noqa: E402
from riskloom.llm.suffix_dedup import remove_repeats  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs, max_bits=3, words_per_shingle=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs, length=400)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="spans", n=10)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", cut_benchmark),
    ("packing", pack_documents),
]

# XXH64 fingerprints, a trained model and byte-pair tokens are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
