"""All registered queries."""

from __future__ import annotations

from tracklab.plans import queries_eval, queries_model, queries_profile, queries_train  # noqa: F401  (register themselves)
from tracklab.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
