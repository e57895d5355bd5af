from riskloom.functions.columns import (  # noqa: F401
    DEMAND_TYPES,
    INBOUND_TYPES,
    OUTBOUND_TYPES,
    md5_uniform,
    normalise_text,
    risk_level,
    risk_score,
    round_cast_long,
    safe_divide,
    signed_quantity,
    strict_greatest,
    strict_least,
    supply_risk_flag,
)
