"""Column-level helpers. All return JVM-side expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transaction-type vocabularies (must equal the source system's).
INBOUND_TYPES = ("receipt", "adjustment_in", "transfer_in")
OUTBOUND_TYPES = ("shipment", "adjustment_out", "transfer_out", "consumption")
DEMAND_TYPES = ("shipment", "consumption", "transfer_out")

# Risk score weights and band cut-offs.
RISK_WEIGHTS = {"late": 0.3, "stockout": 0.3, "coverage": 0.2, "variability": 0.2}
# Limits of the supply-risk rule.
FLAG_ACCELERATION = 1.2
FLAG_LATE = 0.25
FLAG_P90 = 21
HIGH_BAND = 0.7
MEDIUM_BAND = 0.4


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def strict_least(*cols) -> Column:
    """LEAST that returns NULL if any argument is NULL (warehouse semantics)."""
    cs = [_c(c) for c in cols]
    any_null = F.lit(False)
    for c in cs:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def strict_greatest(*cols) -> Column:
    """GREATEST that returns NULL if any argument is NULL (warehouse semantics)."""
    cs = [_c(c) for c in cols]
    any_null = F.lit(False)
    for c in cs:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def round_cast_long(x) -> Column:
    """FLOAT -> INT64 rounding half away from zero, as the warehouse does.

    Spark truncates on cast and rejects non-numeric text under ANSI; this
    rounds first and turns bad text into NULL.
    """
    return F.round(_c(x).try_cast("double"), 0).try_cast("long")


def normalise_text(x) -> Column:
    """LOWER(TRIM(CAST(x AS STRING)))."""
    return F.lower(F.trim(_c(x).cast("string")))


def signed_quantity(type_col="transaction_type", qty_col="quantity") -> Column:
    """+|q| for inbound types, -|q| for outbound types, q unchanged otherwise."""
    t = normalise_text(type_col)
    q = _c(qty_col)
    return (F.when(t.isin(*INBOUND_TYPES), F.abs(q))
            .when(t.isin(*OUTBOUND_TYPES), -F.abs(q))
            .otherwise(q))


def risk_score(late="late_delivery_rate", stockout_days="stockout_days_30d",
               days_of_supply="days_of_supply", cv="demand_cv_30d") -> Column:
    """Weighted 0..1 delay-risk score.

    0.3*late + 0.3*stockout_days/30 + 0.2*(1 - min(dos/30, 1)) + 0.2*min(cv, 1),
    clamped to [0, 1].
    """
    w = RISK_WEIGHTS
    raw = (F.lit(w["late"]) * F.coalesce(_c(late), F.lit(0.0))
           + F.lit(w["stockout"]) * safe_divide(_c(stockout_days), F.lit(30.0))
           + F.lit(w["coverage"]) * (F.lit(1.0) - strict_least(_c(days_of_supply) / F.lit(30.0), F.lit(1.0)))
           + F.lit(w["variability"]) * strict_least(_c(cv), F.lit(1.0)))
    return strict_least(F.lit(1.0), strict_greatest(F.lit(0.0), raw))


def supply_risk_branch(stockout_flag="stockout_flag", acceleration="demand_acceleration_ratio",
                       late="late_delivery_rate", days_of_supply="days_of_supply",
                       lead_p90="lead_time_p90", default_p90: int = FLAG_P90) -> Column:
    """Which branch of the ordered rule fires: 1 stockout and rising demand, 2 late vendor, 3 short coverage, 0 none.

    NULL comparisons fall through to the next branch.
    """
    return (F.when((_c(stockout_flag) == 1) & (_c(acceleration) > FLAG_ACCELERATION), F.lit(1))
            .when(F.coalesce(_c(late), F.lit(0.0)) > FLAG_LATE, F.lit(2))
            .when(_c(days_of_supply) < F.coalesce(_c(lead_p90), F.lit(default_p90)), F.lit(3))
            .otherwise(F.lit(0)))


def supply_risk_flag(*args, **kwargs) -> Column:
    """1 where any branch of ``supply_risk_branch`` fires."""
    return F.when(supply_risk_branch(*args, **kwargs) > 0, F.lit(1)).otherwise(F.lit(0))


def risk_level(score="risk_score", high: float = HIGH_BAND, medium: float = MEDIUM_BAND) -> Column:
    return (F.when(_c(score) >= high, F.lit("HIGH"))
            .when(_c(score) >= medium, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def md5_uniform(key, seed: int = 42) -> Column:
    """Deterministic uniform [0,1) from md5(seed || key): first 8 hex digits / 2^32."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
