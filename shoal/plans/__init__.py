"""Registered queries. Importing this package fills the registry."""

from shoal.plans import columns, io, lake, landing, relational, stats  # noqa: F401
from shoal.plans.base import ORACLES, REGISTRY, load

__all__ = ["ORACLES", "REGISTRY", "load"]
