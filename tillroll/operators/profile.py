"""Counts that describe a dataset: outcomes, groups, totals and the sizes of its state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import utf16_order
from tillroll.operators.aggregate import exact_sum
from tillroll.operators.dictionary import counted_groups, guard_rows, guarded


def reason_counts(prepared: DataFrame) -> DataFrame:
    """Rows per outcome."""
    return prepared.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def missing_code_count(prepared: DataFrame) -> DataFrame:
    """Valid purchases without a category code, in the modes that group by it."""
    return prepared.agg(F.count_if("missing_code").alias("missing_code"))


def group_counts(prepared: DataFrame, max_keys: int | None = None) -> DataFrame:
    """Valid purchases per group in key order; with ``max_keys`` set, more groups fail the job.

    A task that meets too many groups fails at once; the exact count is taken from the groups, which are made once.
    """
    needed = prepared.select("group_key", "price_minor") if max_keys else prepared
    return guarded(counted_groups(guard_rows(needed, max_keys)), max_keys).orderBy(F.expr(utf16_order("group_key")))


def tally(prepared: DataFrame) -> DataFrame:
    """Outcome counts and group states in one pass: a row per group and one per other outcome.

    Both come from one exact aggregate. Metrics observed on the side could count a re-run task twice.
    """
    return prepared.groupBy("reason", "group_key").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum("price_minor").alias("sum_minor"),
        F.count_if("missing_code").alias("missing_code"),
    )


def result_totals(states: DataFrame) -> DataFrame:
    """Group count, purchases and revenue over a whole result."""
    return states.agg(
        F.count(F.lit(1)).alias("group_count"),
        F.coalesce(exact_sum("purchase_count"), F.lit(0)).alias("total_count"),
        F.coalesce(exact_sum("sum_minor"), F.lit(0)).alias("total_sum_minor"),
    )


def state_sizes(states: DataFrame, packed: DataFrame) -> DataFrame:
    """``strategy, records``: purchases, and the rows that hold them as states per slice and as packed states."""
    counts = states.agg(
        F.coalesce(F.sum("purchase_count"), F.lit(0)).alias("direct"),
        F.count(F.lit(1)).alias("partial"),
        F.count(F.lit(1)).alias("dictionary"),
    )
    rows = counts.unpivot([], ["direct", "partial", "dictionary"], "strategy", "records")
    return rows.unionByName(packed.agg(F.lit("packed").alias("strategy"), F.count(F.lit(1)).alias("records")))
