"""Spark jobs for profiling, cleaning, modelling and monitoring record-level cost tables."""

__version__ = "0.1.0"
