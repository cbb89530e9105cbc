"""Run records to one comparison row per variant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import fail_if

_METRICS = ("job_ms", "end_to_end_ms", "with_profile_ms", "shuffle_bytes", "map_records", "reduce_records")


def _measures(runs: DataFrame) -> DataFrame:
    """``variant, effective_variant, metric, value, bucket``: a row for each run and metric.

    Buckets are in the order of the values, some thousands over the whole range of numbers; null values have none. Whole
    numbers stay such, others are decimals.
    """
    integral = all(t in ("tinyint", "smallint", "int", "bigint") for c, t in runs.dtypes if c in _METRICS)
    kind = "bigint" if integral else "decimal(38,6)"
    cells = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast(kind).alias("value")) for m in _METRICS))
    long = runs.select("variant", "effective_variant", F.inline(cells))
    number = F.col("value").cast("double")
    return long.withColumn("bucket", F.floor(F.signum(number) * F.log2(F.abs(number) + 1) * 256))


def _medians(measures: DataFrame, tallied: DataFrame) -> DataFrame:
    """``variant, metric, median``, null where a run lacks the metric.

    Totals of the buckets, which ``tallied`` counts, say which of them hold the middle; only the different values of those
    are counted through.
    """
    group = Window.partitionBy("variant", "metric")
    sizes = tallied.select(
        "variant",
        "metric",
        "bucket",
        "n",
        (F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first())) - F.col("n")).alias("before"),
        F.sum("n").over(group).alias("total"),
        F.sum(F.when(F.col("bucket").isNull(), F.col("n")).otherwise(0)).over(group).alias("nulls"),
    )
    lower = F.call_function("div", F.col("total") + 1, F.lit(2))
    upper = F.call_function("div", F.col("total") + 2, F.lit(2))
    middle = sizes.where((F.col("nulls") == 0) & (upper > F.col("before")) & (lower <= F.col("before") + F.col("n")))
    # Two buckets at most for each variant and metric.
    inside = measures.join(F.broadcast(middle.drop("n", "nulls")), ["variant", "metric", "bucket"])
    keys = ("variant", "metric", "bucket", "before", "total")
    counted = inside.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("variant", "metric", "bucket").orderBy("value")
    ranked = counted.withColumn("last", F.col("before") + F.sum("n").over(upto))

    def at(rank):
        return F.max(F.when(rank.between(F.col("last") - F.col("n") + 1, F.col("last")), F.col("value")))

    both = at(lower).cast("decimal(38,6)") + at(upper).cast("decimal(38,6)")
    return ranked.groupBy("variant", "metric").agg((both / 2).cast("double").alias("median"))


def run_summary(
    records: DataFrame, variants: Sequence[str], repeats: int, baseline: str | None = None
) -> DataFrame:
    """Medians per variant over successful runs that are not warm-ups, and the speed-up over the baseline.

    A variant with fewer than ``repeats`` such runs fails the job. A median over a metric that some
    run lacks is null, never zero.
    """
    baseline = baseline or variants[0]
    measured = records.where(F.col("success") & ~F.col("warmup") & F.col("variant").isin(*variants))
    measured = measured.withColumn("with_profile_ms", F.col("end_to_end_ms") + F.col("profile_ms"))
    measures = _measures(measured)
    # One aggregate gives the extent of the runs as well as the totals of the buckets.
    tallied = measures.groupBy("variant", "metric", "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.collect_set("effective_variant").alias("routes"),  # names of routes
    )
    extent = tallied.where(F.col("metric") == "job_ms").groupBy("variant").agg(
        F.sum("n").alias("runs"),
        F.min("least").cast(dict(measured.dtypes)["job_ms"]).alias("job_min_ms"),
        F.max("most").cast(dict(measured.dtypes)["job_ms"]).alias("job_max_ms"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("routes")))), ",").alias("effective_variant"),
    )
    metric = {m: F.max(F.when(F.col("metric") == m, F.col("median"))).alias(m) for m in _METRICS}
    wide = _medians(measures, tallied).groupBy("variant").agg(*metric.values())
    names = F.array(*(F.lit(v) for v in variants))
    asked = records.sparkSession.range(1).select(F.explode(names).alias("variant"))
    summary = asked.join(extent, "variant", "left").join(wide, "variant", "left")
    # One row per variant is left, so a window over all of them stays small.
    baseline_ms = F.max(F.when(F.col("variant") == baseline, F.col("job_ms"))).over(Window.partitionBy())
    runs = F.coalesce("runs", F.lit(0))
    short = F.concat("variant", F.lit(": fewer valid measured runs than "), F.lit(str(repeats)))
    return summary.select(
        "variant",
        "effective_variant",
        fail_if(runs < repeats, short, runs).alias("runs"),
        F.col("job_ms").alias("job_median_ms"),
        "job_min_ms",
        "job_max_ms",
        F.col("end_to_end_ms").alias("end_to_end_median_ms"),
        F.col("with_profile_ms").alias("with_profile_median_ms"),
        F.col("shuffle_bytes").alias("shuffle_median_bytes"),
        F.col("map_records").alias("map_output_median_records"),
        F.col("reduce_records").alias("reduce_input_median_records"),
        F.when(F.col("job_ms") != 0, baseline_ms / F.col("job_ms")).alias("speedup"),
    )
