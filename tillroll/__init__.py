"""Exact purchase-value roll-ups and dataset audits on Spark DataFrames."""

from tillroll.model import GroupMode

__all__ = ["GroupMode"]
