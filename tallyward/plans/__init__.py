"""Composite jobs and the registered queries."""

import importlib

from tallyward.plans.catalog import ORACLES, QUERIES

for _name in ("cleaning", "feature", "profile", "encode", "evaluate", "drift", "source", "model"):
    importlib.import_module(f"tallyward.plans.{_name}_queries")

__all__ = ["ORACLES", "QUERIES"]
