"""Consolidation of monthly people data on Spark."""

from rosterloom.contract import ColumnSpec, TableContract

__all__ = ["ColumnSpec", "TableContract"]
