import random
import statistics

import pytest
from pyspark.sql import functions as F

from tillroll.operators.summary import run_summary
from tillroll.sources.workload import synthetic_rows

SCHEMA = (
    "variant string, effective_variant string, success boolean, warmup boolean, job_ms bigint, end_to_end_ms bigint, "
    "profile_ms bigint, shuffle_bytes bigint, map_records bigint, reduce_records bigint"
)


def run(variant, job, success=True, warmup=False, profile=0):
    return (variant, variant.upper(), success, warmup, job, job + 1, profile, 100, None, 5)


def test_medians_and_speedup(spark):
    records = [run("v1", t) for t in (9, 10, 11)] + [run("v3", t, profile=None) for t in (4, 5, 6, 7)]
    records += [run("v3", 1, success=False), run("v3", 1, warmup=True)]
    got = {r.variant: r for r in run_summary(spark.createDataFrame(records, SCHEMA), ["v1", "v3"], 3).collect()}
    assert (got["v1"].job_median_ms, got["v3"].job_median_ms, got["v3"].runs) == (10, 5.5, 4)
    assert (got["v3"].job_min_ms, got["v3"].job_max_ms, got["v3"].speedup) == (4, 7, 10 / 5.5)
    assert (got["v1"].with_profile_median_ms, got["v3"].with_profile_median_ms) == (11, None)
    assert got["v1"].map_output_median_records is None and got["v1"].reduce_input_median_records == 5


@pytest.mark.parametrize("kind", ["bigint", "decimal(20,3)", "double"])
def test_medians_of_many_values(spark, kind):
    rng, rows = random.Random(4), []
    for variant, draw in (
        ("v1", lambda: rng.randrange(10**6)), ("v2", lambda: rng.choice([-5, 0, 7])), ("v3", lambda: -rng.randrange(1, 2**40)),
        ("v4", lambda: rng.choice([2**50, 2**50 + 1, 3])), ("v5", lambda: 4),
    ):
        rows += [run(variant, draw()) for _ in range(rng.choice([301, 400]))]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("job_ms", F.col("job_ms").cast(kind))
    names = ["v1", "v2", "v3", "v4", "v5"]
    got = {r.variant: r for r in run_summary(frame, names, 3).collect()}
    for name in names:
        jobs = [r[4] for r in rows if r[0] == name]
        assert got[name].job_median_ms == statistics.median(jobs) and got[name].runs == len(jobs)
        assert (got[name].job_min_ms, got[name].job_max_ms) == (min(jobs), max(jobs))


def test_too_few_runs_fail(spark):
    records = [run("v1", 1, success=False), run("v1", 1, warmup=True)]
    with pytest.raises(Exception, match="fewer valid measured runs"):
        run_summary(spark.createDataFrame(records, SCHEMA), ["v1"], 1).collect()


def test_workload(spark):
    skewed = synthetic_rows(spark, 10, 3, mode="skew", skew=1.0, purchase_rate=1.0)
    assert {r.category_id for r in skewed.collect()} == {"0"}
    many = synthetic_rows(spark, 10, 3, mode="cardinality", purchase_rate=1.0)
    assert many.select("category_id").distinct().count() == 10
    a, b = synthetic_rows(spark, 500, 7, seed=3), synthetic_rows(spark, 500, 7, seed=3).repartition(5)
    assert a.exceptAll(b).count() == 0 and a.exceptAll(synthetic_rows(spark, 500, 7, seed=4)).count() > 0
    for bad in ({"mode": "other"}, {"skew": 2}, {"purchase_rate": -1}):
        with pytest.raises(ValueError):
            synthetic_rows(spark, 10, 3, **bad)
    with pytest.raises(ValueError):
        synthetic_rows(spark, 0, 3)
