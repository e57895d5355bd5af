"""As-of clock: one snapshot date, or many snapshots carried as a column.

Operators take ``as_of`` as a ``date`` (one snapshot) or ``None`` (the
rows carry an ``as_of`` column, e.g. after ``expand_snapshots``). In the
second form ``as_of`` joins every grouping, window and join key, so many
snapshots are computed by one job instead of a driver loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AS_OF_COL = "as_of"


def clock(as_of: dt.date | None) -> tuple[Column, list[str]]:
    if as_of is None:
        return F.col(AS_OF_COL), [AS_OF_COL]
    return F.lit(as_of), []


def in_window(date_col: str | Column, as_of: dt.date | None, days: int) -> Column:
    """Inclusive [as_of - days, as_of]."""
    a, _ = clock(as_of)
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return (d >= F.date_sub(a, days)) & (d <= a)


def expand_snapshots(df: DataFrame, date_col: str, start: dt.date, step_days: int, count: int,
                     horizon_days: int) -> DataFrame:
    """Attach every snapshot date s = start + k*step (k < count) with date <= s <= date + horizon.

    The snapshot indices are computed arithmetically per row and exploded,
    so the expansion is a narrow map (no join, nothing broadcast); a row is
    copied at most ceil(horizon/step)+1 times.
    """
    off = F.datediff(F.col(date_col), F.lit(start))
    lo = F.greatest(F.ceil(off / F.lit(step_days)), F.lit(0)).cast("int")
    hi = F.least(F.floor((off + F.lit(horizon_days)) / F.lit(step_days)), F.lit(count - 1)).cast("int")
    k = "__snap_k"
    return (df.where(hi >= lo)
            .withColumn(k, F.explode(F.sequence(lo, hi)))
            .withColumn(AS_OF_COL, F.date_add(F.lit(start), F.col(k) * F.lit(step_days)))
            .drop(k))


def snapshot_dates(start: dt.date, step_days: int, count: int) -> list[dt.date]:
    return [start + dt.timedelta(days=step_days * i) for i in range(count)]
