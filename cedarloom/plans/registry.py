"""The modules that hold registered queries of the core."""

from __future__ import annotations


def modules() -> list:
    from cedarloom.plans import core_problems, lakehouse, round_trips

    return [core_problems, lakehouse, round_trips]
