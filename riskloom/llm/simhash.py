"""SimHash near-duplicates by multi-index hashing.

Fingerprint: 64 majority bits over the XXH64 of a text's word shingles.
Two fingerprints within ``max_bits`` differ by at most
``max_bits // 2`` bits in one of their two 32-bit segments. Distinct
fingerprints are stored once under the value of each segment; each of them
queries the small Hamming ball around its own segment values, and complete
distances are verified in the join. Copies collapse to one fingerprint
before any pair is formed, so a group of copies of any size is one row.

A segment value that more than ``bucket_limit`` fingerprints share is not
searched as one bucket: its fingerprints are keyed once more by the two
halves of the other segment, with balls of radius ``max_bits // 2`` again
(exact for the same reason), and joined on both keys.

Defined results: a null or empty text has fingerprint zero and is linked
like any other; fewer words than a shingle are one shingle; a component is
named by its smallest doc_id (null ids don't name one); repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import text as X
from riskloom.llm.components import components
from riskloom.llm.frames import fresh, tidied, written

SEED = 42
BUCKET_LIMIT = 2000
_STEP = 1 << 15


def fingerprint(raw: bytes, words_per_shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a text's UTF-8 bytes."""
    words = raw.translate(X.LOWER).split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        n = len(words) - words_per_shingle + 1
        shingles = map(b" ".join, zip(*(words[k:] for k in range(words_per_shingle))))
    digests = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, _STEP):
        h = np.fromiter(digests, dtype=">u8", count=min(_STEP, n - lo))
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fp", words_per_shingle: int = 3) -> DataFrame:
    """docs without the text, plus the fingerprint as a signed long."""
    out = fresh(docs, out_col)
    kept = [f for f in docs.schema.fields if f.name.lower() != text_col.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at = [x.lower() for x in names].index(text_col.lower())
            offsets, data = X.column_bytes(batch.column(at))
            found = np.array([fingerprint(data[offsets[k]:offsets[k + 1]].tobytes(), words_per_shingle)
                              for k in range(batch.num_rows)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(c for k, c in enumerate(batch.columns) if k != at), pa.array(found)],
                                             names=[*(x for k, x in enumerate(names) if k != at), out])
    return docs.mapInArrow(tidied(run), T.StructType([*kept, T.StructField(out, T.LongType(), False)]))


def ball(width: int, radius: int) -> list[int]:
    """All masks of up to ``radius`` bits within ``width``."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _segments(value: Column, width: int, n: int) -> list[Column]:
    """The n segments of ``width`` bits of a value, tagged with their numbers."""
    return [F.shiftrightunsigned(value, k * width).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(k << 40) for k in range(n)]


def _keys(value: Column, width: int, n: int, radius: int | None) -> Column:
    """Segment values (radius None), or the balls around them, as an array."""
    segments = _segments(value, width, n)
    if radius is None:
        return F.array(*segments)
    masks = F.array(*[F.lit(m).cast("long") for m in ball(width, radius)])
    return F.concat(*[_flipped(s, masks) for s in segments])


def _flipped(value: Column, masks: Column) -> Column:
    return F.transform(masks, lambda m: value.bitwiseXOR(m))


def near_links(prints: DataFrame, max_bits: int = 3, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b), a < b, between the distinct fingerprints of ``prints`` (column fp)."""
    radius = max_bits // 2
    table = prints.select("fp", F.explode(_keys(F.col("fp"), 32, 2, None)).alias("key"))
    query = prints.select("fp", F.explode(_keys(F.col("fp"), 32, 2, radius)).alias("key"))
    hot = written(table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_limit).select("key"),
                  "hot-segments")
    if hot.isEmpty():
        return _verified(query, table, ["key"], max_bits).distinct()
    # The segment under which a row is filed says which half is left to search.
    other = F.when(F.shiftright("key", 40) == 0, F.shiftrightunsigned("fp", 32)).otherwise(
        F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)))
    deep = [side.join(hot, "key", "left_semi").withColumn("sub", F.explode(_keys(other, 16, 2, r)))
            for side, r in ((query, radius), (table, None))]
    flat = [side.join(hot, "key", "left_anti") for side in (query, table)]
    return _verified(*flat, ["key"], max_bits).union(_verified(*deep, ["key", "sub"], max_bits)).distinct()


def _verified(query: DataFrame, table: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    q = query.select(F.col("fp").alias("a"), *[F.col(k).alias(f"q_{k}") for k in keys])
    t = table.select(F.col("fp").alias("b"), *[F.col(k).alias(f"t_{k}") for k in keys])
    on = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    for k in keys:
        on = on & (F.col(f"q_{k}") == F.col(f"t_{k}"))
    return q.join(t, on).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 3,
                    words_per_shingle: int = 3, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """A row per document: doc_id, text_hash (XXH64), fp (signed long), component_id (smallest linked doc_id)."""
    return _rooted(docs, id_col, text_col, max_bits, words_per_shingle, bucket_limit).drop("root")


def _rooted(docs: DataFrame, id_col: str, text_col: str, max_bits: int = 3, words_per_shingle: int = 3,
            bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """The rows of near_duplicates plus root: a fingerprint of each component, its own whatever the ids are."""
    text = F.col(f"`{text_col}`")
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                      text.alias("text"))
    rows = written(fingerprints(ids, "text", "fp", words_per_shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    roots = components(near_links(classes.select("fp"), max_bits, bucket_limit))
    named = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    linked = named.join(roots.select("root").distinct(), "root", "left_semi")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(lowest, "root", "left").select(
        "fp", "root", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.join(of_class, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


# Rows of ids and hashes up to which Spark may plan the decisions' join as it likes (a broadcast is bounded by its size).
SMALL_DECISIONS = 200_000


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Keep one document of each component: the one whose id names it. Columns as in docs.

    If several rows of a component have that id, one of them stays (smallest
    text hash). Components without any id can't be named; all their rows stay.

    All is decided on ids and hashes, stored as a table; then the documents
    are read once and matched with it. Beyond ``SMALL_DECISIONS`` rows the
    match is a hash join whose built side are the decisions, so texts are
    shuffled once and never sorted.
    """
    found = written(_rooted(docs, id_col, text_col, **options), "near-duplicates")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    named = found.where(F.col("component_id").isNotNull() & own).groupBy("root", "doc_id").agg(
        F.min("text_hash").alias("text_hash"))
    # Rows with one id and one text that must become one; usually none.
    times = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    nameless = found.where(F.col("component_id").isNull()).select("doc_id", "text_hash").distinct()
    kept = written(named.select("doc_id", "text_hash").distinct().join(times, ["doc_id", "text_hash"]).unionByName(
        nameless.withColumn("n", F.lit(1).cast("long"))), "kept-documents")
    n_kept, n_repeated = kept.agg(F.count(F.lit(1)), F.count_if(F.col("n") > 1)).first()
    here, text_hash = F.col(f"`{id_col}`"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))

    def matched(decisions: DataFrame) -> DataFrame:
        side = decisions.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        if n_kept > SMALL_DECISIONS:
            side = side.hint("shuffle_hash")
        return docs.join(side, here.eqNullSafe(F.col("__id")) & (text_hash == F.col("__hash")), "left_semi")
    if not n_repeated:
        return matched(kept)
    again = matched(kept.where("n > 1")).withColumn("__hash", text_hash).dropDuplicates([id_col, "__hash"]).drop("__hash")
    return matched(kept.where("n = 1")).unionByName(again)
