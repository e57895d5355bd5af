"""All oracle SQL, gathered from the oracle modules."""

from __future__ import annotations

import importlib

ORACLE_MODULES = ("riskloom.plans.oracle", "riskloom.plans.registry_io",
                  "riskloom.plans.registry_stream", "riskloom.plans.registry_ml")


def all_oracles() -> dict[str, str]:
    from riskloom.plans.oracle import ORACLES
    for m in ORACLE_MODULES:
        importlib.import_module(m)
    return ORACLES
