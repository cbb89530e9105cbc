"""Checks on result tables: line rules, duplicates, totals, and equality of two results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.profile import result_totals
from tillroll.session import row_count


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def result_violations(parsed: DataFrame) -> DataFrame:
    """``violation, group_key, n`` over parsed result lines: broken rules and repeated keys.

    Sound rows count zero instead of being filtered; a filter on ``violation`` would make Spark
    parse every line twice.
    """
    broken = parsed.groupBy("violation", "group_key").agg(F.count("violation").alias("n"))
    repeated = parsed.groupBy("group_key").agg(F.count_if(F.col("violation").isNull()).alias("n"))
    repeated = repeated.select(F.lit("duplicate_key").alias("violation"), "group_key", "n")
    return broken.where(F.col("n") > 0).unionByName(repeated.where(F.col("n") > 1))


def validate_result(parsed: DataFrame, expected_count: int | Column, max_keys: int | None = None) -> DataFrame:
    """One row: totals, the broken rules, and ``valid`` when the result may be published.

    ``too_many_groups`` tells a result beyond ``max_keys``, for callers that have such a limit, from
    one that does not add up.
    """
    sound = F.col("violation").isNull()
    totals = result_totals(
        parsed.select(
            F.when(sound, F.col("purchase_count")).alias("purchase_count"),
            F.when(sound, F.col("sum_minor")).alias("sum_minor"),
        )
    )
    over = F.lit(False) if max_keys is None else F.col("group_count") > max_keys
    checked = totals.withColumn("violations", row_count(result_violations(parsed))).withColumn("too_many_groups", over)
    sums = (F.col("violations") == 0) & (F.col("total_count") == F.lit(expected_count))
    return checked.withColumn("valid", sums & ~F.col("too_many_groups"))


def result_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """The keys whose sum or count differs between two results, or that only one of them has."""
    a = left.select("group_key", F.col("sum_minor").alias("left_sum"), F.col("purchase_count").alias("left_count"))
    b = right.select("group_key", F.col("sum_minor").alias("right_sum"), F.col("purchase_count").alias("right_count"))
    same = F.col("left_sum").eqNullSafe(F.col("right_sum")) & F.col("left_count").eqNullSafe(F.col("right_count"))
    difference = (
        F.when(F.col("right_count").isNull(), "only_left").when(F.col("left_count").isNull(), "only_right").otherwise("differs")
    )
    return a.join(b, "group_key", "full_outer").where(~same).withColumn("difference", difference)


def state_violations(states: DataFrame, *keep: str) -> DataFrame:
    """``rule`` for every partial state outside the monoid: negative parts, or a sum without a count."""
    total, count = F.col("sum_minor"), F.col("purchase_count")
    rule = (
        F.when(total.isNull() | count.isNull(), "null_part")
        .when(total < 0, "negative_sum")
        .when(count < 0, "negative_count")
        .when((count == 0) & (total != 0), "sum_without_count")
    )
    judged = states.select(*keep, "sum_minor", "purchase_count", rule.alias("rule"))
    return judged.where(F.col("rule").isNotNull())


def packed_violations(packed: DataFrame, *keep: str, max_entries: int) -> DataFrame:
    """Packed rows of more than ``max_entries`` or with an entry that no state can be."""
    too_long = packed.where(F.size("entries") > max_entries).select(*keep, "bucket", F.lit("batch_too_long").alias("rule"))
    entries = packed.select(*keep, "bucket", F.inline("entries"))
    bad = (F.col("id") < 0) | (F.col("sum_minor") < 0) | (F.col("purchase_count") <= 0)
    return too_long.unionByName(entries.where(bad).select(*keep, "bucket", F.lit("invalid_entry").alias("rule")))


def reconciliation(tallied: DataFrame, fresh_statistics: DataFrame, states: DataFrame) -> DataFrame:
    """One row: the purchases counted by the run, by a fresh preflight and in the result, and whether they agree."""
    counted = tallied.agg(F.coalesce(F.sum(F.when(F.col("reason") == "VALID_PURCHASE", F.col("n"))), F.lit(0)).alias("counted"))
    preflight = fresh_statistics.agg(F.coalesce(F.sum("valid_purchases"), F.lit(0)).alias("p")).scalar()
    in_result = states.agg(F.coalesce(F.sum("purchase_count"), F.lit(0)).alias("p")).scalar()
    row = counted.select("counted", preflight.alias("preflighted"), in_result.alias("in_result"))
    return row.withColumn(
        "reconciled", (F.col("counted") == F.col("preflighted")) & (F.col("counted") == F.col("in_result"))
    )
