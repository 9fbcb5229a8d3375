"""Data-quality checks on monthly snapshots of event tables, as lazy DataFrames."""

from .context import Context
from .profile import MEDICAL, PHARMACY, DimensionColumns, TableProfile, Thresholds

__all__ = ["Context", "DimensionColumns", "MEDICAL", "PHARMACY", "TableProfile", "Thresholds"]
