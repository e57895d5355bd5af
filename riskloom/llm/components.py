"""Connected components of a link table by alternating star contractions.

Each round hangs every node's larger neighbours on its smallest neighbour
(large star), then its smaller neighbours (small star), and is written to
the shared folder. The number of rounds grows with the logarithm of the
longest path; nothing is collected but a count and a checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("__u")).agg(F.least(F.min("b"), F.first("a")).alias("__m"))
    return (both.where("b > a").join(low, F.col("a") == F.col("__u"))
            .select(F.col("b").alias("a"), F.col("__m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    low = down.groupBy(F.col("a").alias("__u")).agg(F.min("b").alias("__m"))
    hung = down.join(low, F.col("a") == F.col("__u")).where("b > __m").select(F.col("b").alias("a"), F.col("__m").alias("b"))
    return hung.union(low.select("__u", "__m")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """links (a, b of one orderable type) -> (node, root): the smallest node of each linked node's component."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                    "links")
    mark = _mark(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
