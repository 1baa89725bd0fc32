"""All registered checks."""

from __future__ import annotations

from checks import activity_checks, field_checks, operator_checks, scalar_checks, suppression_checks
from checks.registry import Check


def all_checks() -> dict[str, Check]:
    out: dict[str, Check] = {}
    for module in (suppression_checks, activity_checks, field_checks, operator_checks, scalar_checks):
        clash = out.keys() & module.CHECKS.keys()
        if clash:
            raise ValueError(f"registered twice: {clash}")
        out.update(module.CHECKS)
    return out
