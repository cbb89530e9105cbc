"""Labelled synthetic purchases for measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.model import DEFAULT_SEED

MODES = ("uniform", "skew", "cardinality")
_DRAW_BITS = 48


def _draw(index: Column, seed: int, purpose: str) -> Column:
    """A number in [0, 1) fixed by seed, purpose and row; no task order or partitioning enters it."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), index.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, _DRAW_BITS // 4), 16, 10).cast("bigint") / F.lit(
        float(2**_DRAW_BITS)
    )


def synthetic_events(
    index: DataFrame,
    column: str,
    groups: int,
    mode: str = "uniform",
    skew: float = 0.9,
    purchase_rate: float = 0.2,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """One event per row of ``index``, in the nine-column shape.

    ``skew`` sends that share of the rows to group 0; ``cardinality`` gives every row its own group.
    """
    if groups < 1 or mode not in MODES:
        raise ValueError("Positive groups and a known mode required")
    if not (0 <= skew <= 1 and 0 <= purchase_rate <= 1):
        raise ValueError("skew and purchase_rate must lie in [0, 1]")
    row = F.col(column)
    group = row if mode == "cardinality" else F.floor(_draw(row, seed, "group") * groups)
    if mode == "skew":
        group = F.when(_draw(row, seed, "skew") < skew, F.lit(0)).otherwise(group)
    cents = F.floor(_draw(row, seed, "price") * 5001)
    drawn = index.select(
        row.alias("row"),
        group.cast("bigint").alias("group"),
        cents.cast("bigint").alias("cents"),
        (_draw(row, seed, "type") < purchase_rate).alias("bought"),
    )
    price = F.concat(
        F.call_function("div", F.col("cents"), F.lit(100)).cast("string"),
        F.lit("."),
        F.lpad((F.col("cents") % 100).cast("string"), 2, "0"),
    )
    return drawn.select(
        F.lit("2019-10-01 00:00:00 UTC").alias("event_time"),
        F.when(F.col("bought"), "purchase").otherwise("view").alias("event_type"),
        (F.col("row") % 1000).cast("string").alias("product_id"),
        F.col("group").cast("string").alias("category_id"),
        F.concat(F.lit("synthetic.category"), F.col("group").cast("string")).alias("category_code"),
        F.lit("synthetic").alias("brand"),
        price.alias("price_text"),
        F.lit("synthetic-user").alias("user_id"),
        F.lit("synthetic-session").alias("user_session"),
    )


def synthetic_rows(spark: SparkSession, rows: int, groups: int, **options) -> DataFrame:
    if rows < 1:
        raise ValueError("Positive rows required")
    return synthetic_events(spark.range(rows), "id", groups, **options)
