"""Staging of files as they arrive."""

from rosterloom.streaming.arrivals import read_arrived, stage_arrivals, stage_arriving_layouts

__all__ = ["read_arrived", "stage_arrivals", "stage_arriving_layouts"]
