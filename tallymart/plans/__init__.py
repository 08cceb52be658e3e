"""Registered queries: the operators applied to the given tables, each with its SQL twin."""

from tallymart.plans import archive, market, places, reading, shaping, sourcing, values  # noqa: F401
from tallymart.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
