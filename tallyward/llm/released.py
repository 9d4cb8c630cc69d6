"""Staged tables that leave no shuffle files behind."""

from tallyward.operators.staging import released

__all__ = ["released"]
