"""Headline timings: prints one JSON line.

Each query runs once to warm up and then ``BENCH_REPEATS`` times in random order; the median is
reported. Building the frame, planning and collecting the result all count. The CSV workload of
200,000 purchases in 32 groups is written before the clock starts, and so is its dictionary, whose
time is reported apart.
"""

from __future__ import annotations

import json
import os
import random
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.functions.csvline import parse_event_lines  # noqa: E402
from tillroll.model import GroupMode  # noqa: E402
from tillroll.operators import aggregate as agg  # noqa: E402
from tillroll.operators import dictionary as dic  # noqa: E402
from tillroll.operators.prepare import prepare  # noqa: E402
from tillroll.plans import runs  # noqa: E402
from tillroll.plans.catalog import QUERIES  # noqa: E402
from tillroll.session import materialize  # noqa: E402
from tillroll.sinks import writers  # noqa: E402
from tillroll.sources.files import list_csv, scan_splits  # noqa: E402
from tillroll.sources.workload import synthetic_rows  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = max(3, int(os.environ.get("BENCH_REPEATS", "3")))
HEADLINE = (
    "purchase_value_by_category_id",
    "purchase_value_by_category_root",
    "order_value_by_customer",
    "line_value_by_part",
    "line_value_by_brand",
    "event_reason_counts",
    "line_value_by_category_code",
    "strategy_direct",
    "strategy_dictionary",
    "strategy_packed",
    "hash_sample_type_shares",
    "preflight_totals",
    "input_drift",
    "synthetic_skew",
    "run_summary",
)


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="tillroll-bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tillroll-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        began = time.monotonic()
        action()
        return time.monotonic() - began

    workload = synthetic_rows(spark, 200_000, 32, purchase_rate=1.0)
    line = "concat_ws(',', event_time, event_type, product_id, category_id, category_code, brand, price_text, user_id, user_session)"
    writers.write_sample(workload.selectExpr(f"{line} AS value").coalesce(1), f"{scratch}/purchases.csv")
    files = list_csv(spark, f"{scratch}/purchases.csv")

    def purchases():
        return prepare(parse_event_lines(scan_splits(spark, files)), GroupMode.CATEGORY_ID)

    built = {}

    def build_dictionary():
        built["groups"] = materialize(dic.build_dictionary(dic.counted_groups(purchases())))

    build_dictionary()
    dictionary_sec = timed(build_dictionary)
    runs_done = iter(range(1_000_000))
    actions = {f"csv200k_{s}": (lambda s=s: agg.aggregate(purchases(), s, built["groups"]).collect()) for s in agg.STRATEGIES}
    actions["csv200k_checked_run"] = lambda: runs.run_aggregate(spark, files, f"{scratch}/result-{next(runs_done)}")
    actions |= {name: (lambda q=QUERIES[name]: q(spark, SF_DIR).collect()) for name in HEADLINE}

    rng = random.Random(21)
    seconds: dict[str, list[float]] = {name: [] for name in actions}
    for action in actions.values():
        action()
    for _ in range(REPEATS):
        for name in rng.sample(list(actions), len(actions)):
            seconds[name].append(timed(actions[name]))
    medians = {name: round(statistics.median(s), 4) for name, s in seconds.items()}
    report = {
        "metric": "sum of median query times",
        "value": round(sum(medians.values()), 4),
        "unit": "sec",
        "queries": medians,
        "spread": {name: [round(min(s), 4), round(max(s), 4)] for name, s in seconds.items()},
        "dictionary_preparation_sec": round(dictionary_sec, 4),
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "repeats": REPEATS,
    }
    print(json.dumps(report), flush=True)


if __name__ == "__main__":
    main()
