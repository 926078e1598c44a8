"""Imports every query module so that the registry is complete."""

from cadence.plans import q_eval, q_explore, q_layers, q_ml, q_sketch, q_stream  # noqa: F401
from cadence.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
