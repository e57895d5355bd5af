"""Exact running sums over a large ordered key without a single-task window.

A window ordered over a whole feature (or the whole table) puts every row
in one task. Here the rows are counted first and cut into as many ranges of
the order as that number asks for (Spark's range partitioner samples the
cuts); every range is stored with its number. The second level is a scan
over the totals of the ranges, one small row per (group, range), which gives
each range its starting offset; the running sum inside a range is a window
of its own. The result is exact, whatever the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.streaming.runner import materialize

ROWS_PER_RANGE = 200_000
# The offsets (rows of ranges) are broadcast up to this many, joined beyond it.
BROADCAST_RANGES = 200_000


def prefix_sums(df: DataFrame, groups: Sequence[str], order_col: str, value_cols: Sequence[str],
                inclusive: bool = True, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``cum_<v>`` = sum of v over rows of the same group with order <= (or <) this row, and ``total_<v>`` of the group.

    ``df`` should already hold one row per (group, order value) for ties to
    be handled as a unit (aggregate first). It is computed once and stored;
    the result reads the stored rows twice.
    """
    g = list(groups)
    rows = materialize(df, "prefix-rows")
    n_ranges = max(1, -(-rows.count() // rows_per_range))
    if n_ranges > 1:
        # Ranges of (group, order): a group of any size is cut, small ones share a range.
        rows = materialize(rows.repartitionByRange(n_ranges, *g, order_col)
                           .withColumn("__range", F.spark_partition_id()), "prefix-ranges")
    else:
        rows = rows.withColumn("__range", F.lit(0))
    totals = rows.groupBy(*g, "__range").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    before = Window.partitionBy(*g).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*g)
    offsets = totals.select(
        *g, "__range", *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in value_cols],
        *[F.sum(f"__t_{v}").over(whole).alias(f"total_{v}") for v in value_cols])
    if g:
        n_offsets = n_ranges + rows.select(*g).distinct().count()  # a range holds a part of one group, or whole groups
    else:
        n_offsets = n_ranges
    if n_offsets <= BROADCAST_RANGES:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*g, "__range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = rows.join(offsets, [*g, "__range"])
    return out.select(*df.columns, *[(F.col(f"__o_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"cum_{v}")
                                     for v in value_cols], *[f"total_{v}" for v in value_cols])
