"""The queries of the engine by name, and their SQL."""

from __future__ import annotations

import inspect

from scholmill.plans import oracles
from scholmill.plans import queries as Q


def queries() -> dict:
    """Every public function of ``plans.queries`` that takes (spark, sf_dir), but for helpers."""
    return {name: f for name, f in vars(Q).items() if inspect.isfunction(f) and f.__module__ == Q.__name__ and not name.startswith("_") and name != "raw_works"}


def oracle_sql() -> dict:
    return oracles.oracle_sql()
