"""Sums that fail where they would be wrong."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(column: str) -> Column:
    """A ``bigint`` sum that fails on overflow whether or not the session runs in ANSI mode."""
    total, message = f"try_sum({column})", f"Sum of {column} leaves the range of bigint"
    return F.expr(f"if({total} IS NULL AND count({column}) > 0, raise_error('{message}'), {total})")
