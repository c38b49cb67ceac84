"""Imports every query module so the registry is complete."""

from . import q_core, q_drift, q_functions, q_joins, q_metrics, q_models, q_sources, q_stream  # noqa: F401
from .registry import OPERATORS, ORACLE, QUERIES  # noqa: F401
