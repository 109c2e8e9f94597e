"""Registered queries by area."""

from variloom.plans import cohort, genome, quality, roundtrip, state, streams, tags  # noqa: F401
from variloom.plans.registry import RUNS

__all__ = ["RUNS"]
