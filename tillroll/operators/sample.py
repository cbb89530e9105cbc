"""Deterministic samples of event lines."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from tillroll.functions.keys import sample_bucket
from tillroll.model import DEFAULT_SEED, SAMPLE_BUCKETS


def sample_threshold(rate: float) -> int:
    if not (math.isfinite(rate) and 0 < rate <= 1):
        raise ValueError("rate must lie in (0, 1]")
    return math.floor(rate * SAMPLE_BUCKETS)


def hash_sample(rows: DataFrame, rate: float, seed: int = DEFAULT_SEED) -> DataFrame:
    """The rows whose place falls below the rate; the same ones for any partitioning or order.

    Rows need ``uri`` and ``offset``. Rows of every event type are kept alike.
    """
    return rows.where(f"{sample_bucket('uri', 'offset', seed, SAMPLE_BUCKETS)} < {sample_threshold(rate)}")
