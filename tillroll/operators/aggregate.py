"""Total, count and half-up average per group, by three routes with one result.

All routes end in partial states ``(sum_minor, purchase_count)`` per key. States merge in any
order; an average is formed once, from the final state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import average_minor, format_minor
from tillroll.functions.sums import exact_sum
from tillroll.operators.dictionary import decode, encode

STRATEGIES = ("partial", "dictionary", "packed")
# Names of the routes. Spark aggregates in each task before it shuffles, and spills,
# so routes without (v1), with (v2) and with a bounded cache for it (v3) are one here.
VARIANTS = {"v1": "partial", "v2": "partial", "v3": "partial", "v4": "dictionary", "v5": "packed"}
#: Ids to a packed row.
PACKED_IDS = 1024


def key_or_blank() -> Column:
    """The group key, or an empty text, which is no key, on rows that are no valid purchase.

    Spark filters null keys ahead of a join, which would work out every key twice; this is never null.
    """
    return F.expr("coalesce(group_key, '') AS group_key")


def _states(grouped, amount: str = "price_minor") -> DataFrame:
    """States of the keys that hold at least one valid purchase.

    Rows without a valid purchase carry a null amount, and meet in a blank group that the count
    drops. Filtering them first would make Spark evaluate key and amount twice, once in the filter.
    """
    states = grouped.agg(exact_sum(amount).alias("sum_minor"), F.count(amount).alias("purchase_count"))
    return states.where("purchase_count > 0")


def partial(prepared: DataFrame) -> DataFrame:
    """Pre-aggregate in each task, shuffle states only. The default: a hot key costs one row a task."""
    return _states(prepared.groupBy(key_or_blank()))


def merge_states(states: DataFrame, *keys: str) -> DataFrame:
    """Merge partial states by key; associative, commutative, with ``(0, 0)`` as identity."""
    merged = states.groupBy(*(keys or ("group_key",))).agg(
        exact_sum("sum_minor").alias("sum_minor"), exact_sum("purchase_count").alias("purchase_count")
    )
    return merged.where("purchase_count > 0")


def partial_states(prepared: DataFrame, slice_column: str) -> DataFrame:
    """One state per slice and key, to be kept and merged later."""
    return _states(prepared.groupBy(slice_column, key_or_blank()))


def by_dictionary(prepared: DataFrame, dictionary: DataFrame) -> DataFrame:
    """States on integer ids, each key looked up once, with the names put back at the end."""
    return decode(encode(partial(prepared), dictionary), dictionary).select("group_key", "sum_minor", "purchase_count")


def pack(prepared: DataFrame, dictionary: DataFrame, slice_column: str, ids: int = PACKED_IDS) -> DataFrame:
    """``slice, bucket, entries``: the states of a slice, those of ``ids`` neighbouring ids in one row.

    Rows are reduced to states before ids are looked up and before anything is collected; an array
    has ``ids`` entries at most.
    """
    return pack_states(partial_states(prepared, slice_column), dictionary, slice_column, ids)


def pack_states(states: DataFrame, dictionary: DataFrame, slice_column: str, ids: int = PACKED_IDS) -> DataFrame:
    """:func:`pack` from states that exist already, one for each slice and key."""
    if ids < 1:
        raise ValueError("ids must be positive")
    states = encode(states, dictionary)
    entry = F.struct("id", "sum_minor", "purchase_count")
    return states.groupBy(slice_column, F.expr(f"id div {ids} AS bucket")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )


def unpack(packed: DataFrame) -> DataFrame:
    return packed.select(F.inline("entries"))


def merge_packed(packed: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The states of all slices, by key; an entry that the dictionary does not list fails the job."""
    merged = merge_states(unpack(packed), "id")
    return decode(merged, dictionary).select("group_key", "sum_minor", "purchase_count")


def aggregate(
    prepared: DataFrame,
    strategy: str = "partial",
    dictionary: DataFrame | None = None,
    slice_column: str | None = None,
    packed_ids: int = PACKED_IDS,
) -> DataFrame:
    """``group_key, sum_minor, purchase_count`` by the named route (or its variant name)."""
    strategy = VARIANTS.get(strategy, strategy)
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}")
    if strategy == "partial":
        return partial(prepared)
    if dictionary is None:
        raise ValueError(f"Strategy {strategy} needs a dictionary")
    if strategy == "dictionary":
        return by_dictionary(prepared, dictionary)
    if slice_column is None:
        prepared, slice_column = prepared.withColumn("slice", F.spark_partition_id()), "slice"
    return merge_packed(pack(prepared, dictionary, slice_column, packed_ids), dictionary)


def route_states(states: DataFrame, strategy: str, dictionary: DataFrame | None, slice_column: str) -> DataFrame:
    """:func:`aggregate` from stored states of each slice and key, without another look at the rows."""
    strategy = VARIANTS.get(strategy, strategy)
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}")
    if strategy == "partial":
        return merge_states(states)
    if dictionary is None:
        raise ValueError(f"Strategy {strategy} needs a dictionary")
    if strategy == "packed":
        return merge_packed(pack_states(states, dictionary, slice_column), dictionary)
    return decode(encode(merge_states(states), dictionary), dictionary).select("group_key", "sum_minor", "purchase_count")


def result_rows(states: DataFrame) -> DataFrame:
    """States with their total and average as plain two-decimal text."""
    return states.selectExpr(
        "group_key",
        "sum_minor",
        "purchase_count",
        f"{format_minor('sum_minor')} AS total_revenue",
        f"{format_minor(average_minor('sum_minor', 'purchase_count'))} AS average_revenue",
    )
