"""Exact discrete quantiles of an integer-valued measure from per-group histograms.

For measures with a bounded integer domain (lead times in days), the
p-quantile (smallest value whose cumulative share reaches p, i.e.
``percentile_disc``) is found from (group, value) counts: a partial/final
aggregate shrinks the data to one row per distinct value per group, and a
running count over that histogram picks the value. A hot group costs one
row per distinct value, never one row per input row. Comparisons are done
in integers (cum * den >= num * n), so no float rounding moves a boundary.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram_quantiles(df: DataFrame, keys: Sequence[str], value_col: str, probs: Sequence[float],
                        names: Sequence[str], extra_sums: dict[str, Column] | None = None,
                        weight: Column | None = None) -> DataFrame:
    """One row per group: ``names[i]`` = discrete ``probs[i]``-quantile, ``__n`` = count,
    plus ``extra_sums`` (name -> per-row expression) summed per group.

    Rows without a measure count in ``__n`` and the sums; the quantiles are of
    the rows that have one (NULL if none has).
    ``weight`` lets pre-aggregated rows (value, count) stand for ``count`` rows.
    """
    extra_sums = extra_sums or {}
    k = list(keys)
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    hist = (df.groupBy(*k, value_col)
            .agg(w.alias("__c"), *[F.sum(e).alias(n) for n, e in extra_sums.items()]))
    w_cum = Window.partitionBy(*k).orderBy(F.col(value_col).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*k)
    measured = F.when(F.col(value_col).isNotNull(), F.col("__c"))
    h = hist.withColumns({"__cum": F.sum("__c").over(w_cum), "__measured": F.sum(measured).over(w_all),
                          "__n": F.sum("__c").over(w_all)})
    aggs = []
    for p, name in zip(probs, names):
        fr = Fraction(p).limit_denominator(10_000)
        hit = F.col("__cum") * F.lit(fr.denominator) >= F.col("__measured") * F.lit(fr.numerator)
        aggs.append(F.min(F.when(hit, F.col(value_col))).alias(name))
    aggs += [F.sum(n).alias(n) for n in extra_sums]
    return h.groupBy(*k).agg(*aggs, F.first("__n").alias("__n"))
