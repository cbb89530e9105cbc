"""Every registered query: a callable from a session and a table folder to a DataFrame."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions.csvline import parse_event_lines
from tillroll.functions.keys import sample_bucket
from tillroll.functions.money import average_minor, format_minor, with_minor
from tillroll.model import EVENT_COLUMNS, HEADER_LINE, GroupMode
from tillroll.operators import aggregate as agg
from tillroll.operators import compare, digests, manifest, preflight, profile, sample, summary
from tillroll.operators import dictionary as dic
from tillroll.operators.prepare import PREPARED_COLUMNS, prepare, purchases_only
from tillroll.plans import runs
from tillroll.session import fail_if, materialize, new_shared_path, row_count
from tillroll.sinks import writers
from tillroll.sinks.rollup import Rollup
from tillroll.sources import tables
from tillroll.sources.files import list_csv, scan_lines
from tillroll.sources.results import parse_result_lines, read_result_lines
from tillroll.sources.workload import synthetic_events

Query = Callable[[SparkSession, str], DataFrame]
ID, CODE, ROOT = GroupMode.CATEGORY_ID, GroupMode.CATEGORY_CODE, GroupMode.CATEGORY_ROOT
EVENT_FIELDS = [{"price": "price_text"}.get(c, c) for c in EVENT_COLUMNS]
SAMPLE_URI = "table:events"
SAMPLE_RATE = 0.25
SAMPLE_SEED = 21
PACKED_IDS = 32


def _purchases(spark: SparkSession, sf: str, mode: GroupMode, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prepared rows of the dirty events that can be purchases; the type test reaches the scan."""
    return prepare(purchases_only(tables.events_dirty(spark, sf)), mode, keep)


def _states(spark: SparkSession, sf: str, mode: GroupMode = ID) -> DataFrame:
    return agg.partial(_purchases(spark, sf, mode))


def _dictionary(spark: SparkSession, sf: str, mode: GroupMode = ID) -> DataFrame:
    """Built once into the shared folder: it is looked up at the start and at the end of a query."""
    return materialize(dic.build_dictionary(dic.counted_groups(_purchases(spark, sf, mode))))


# Roll-ups


def purchase_value_by_category_id(spark: SparkSession, sf: str) -> DataFrame:
    events = purchases_only(tables.events_as_raw(spark, sf))
    return agg.result_rows(agg.partial(prepare(events, ID)))


def purchase_value_by_category_code(spark: SparkSession, sf: str) -> DataFrame:
    return agg.result_rows(_states(spark, sf, CODE))


def purchase_value_by_category_root(spark: SparkSession, sf: str) -> DataFrame:
    return agg.result_rows(_states(spark, sf, ROOT))


def order_value_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    return agg.result_rows(agg.partial(prepare(tables.orders_as_events(spark, sf), ID)))


def order_value_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    return agg.result_rows(agg.partial(prepare(tables.orders_as_events(spark, sf), ROOT)))


def line_value_by_part(spark: SparkSession, sf: str) -> DataFrame:
    return agg.result_rows(agg.partial(prepare(tables.lineitem_as_events(spark, sf), ID)))


def line_value_by_brand(spark: SparkSession, sf: str) -> DataFrame:
    """Lines become one state per part before they meet ``part``, so a hot part is one row in the join.

    Both sides grow with the data, so neither is broadcast by hand; Spark decides by their sizes. A
    line whose part is not listed fails the job.
    """
    per_part = agg.partial(prepare(tables.lineitem_as_events(spark, sf), ID))
    part = tables.read_table(spark, sf, "part")
    brands = part.select(F.col("p_partkey").cast("string").alias("group_key"), F.col("p_brand").alias("brand"))
    joined = per_part.join(brands, "group_key", "left")
    message = F.concat(F.lit("Part without a brand: "), F.col("group_key"))
    joined = joined.withColumn("brand", fail_if(F.col("brand").isNull(), message, F.col("brand")))
    merged = agg.merge_states(joined, "brand")
    return agg.result_rows(merged.withColumnRenamed("brand", "group_key"))


# Classification


def event_reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.reason_counts(prepare(tables.events_dirty(spark, sf), ID))


def event_reason_counts_by_root(spark: SparkSession, sf: str) -> DataFrame:
    return profile.reason_counts(prepare(tables.events_dirty(spark, sf), ROOT))


def missing_code_count(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_code_count(_purchases(spark, sf, CODE))


def prepared_purchases(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepare(tables.events_dirty(spark, sf), CODE, keep=("event_id",))
    return prepared.select("event_id", *PREPARED_COLUMNS)


def event_tally(spark: SparkSession, sf: str) -> DataFrame:
    return profile.tally(prepare(tables.events_dirty(spark, sf), CODE))


# Scalars


def _price_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's amount in one of twelve spellings, half of them not exact amounts."""
    events = tables.read_table(spark, sf, "events").selectExpr(
        "event_id", "CAST(round(value * 100) AS BIGINT) AS cents", f"{tables.amount_text('value')} AS text"
    )
    spellings = (
        "text",
        "concat(text, '000')",
        "concat(' \\t+', text, '\\n')",
        "concat(cents, 'e-2')",
        "concat(cents, '0E-03')",
        "concat('0000000000000000000000', cents, '.')",
        "concat(text, '1')",
        "concat(cents, '1e-3')",
        "concat('-', text)",
        "concat(text, ' x')",
        "concat(cents, 'e30')",
        "'-0.000'",
    )
    return events.selectExpr("event_id", f"elt(1 + event_id % {len(spellings)}, {', '.join(spellings)}) AS price_text")


def money_parse(spark: SparkSession, sf: str) -> DataFrame:
    return with_minor(_price_spellings(spark, sf), "price_text", "price_minor").select("event_id", "price_minor")


def money_average(spark: SparkSession, sf: str) -> DataFrame:
    """Spend per user over all events, as text: total, and average rounded half up."""
    events = tables.read_table(spark, sf, "events")
    per_user = with_minor(events, tables.amount_text("value"), "minor").groupBy("user_id")
    states = per_user.agg(agg.exact_sum("minor").alias("total"), F.count("minor").alias("n"))
    return states.selectExpr(
        "user_id",
        f"{format_minor('total')} AS total_text",
        f"{format_minor(average_minor('total', 'n'))} AS average_text",
    )


def sample_buckets(spark: SparkSession, sf: str) -> DataFrame:
    events = tables.read_table(spark, sf, "events")
    return events.selectExpr("event_id", f"{sample_bucket(repr(SAMPLE_URI), 'event_id', -SAMPLE_SEED, 1000)} AS bucket")


# Lines


def parsed_event_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _line_fields(parse_event_lines(tables.event_lines(spark, sf), fast_path=False))


def projected_event_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _line_fields(parse_event_lines(tables.event_lines(spark, sf)))


def _line_fields(parsed: DataFrame) -> DataFrame:
    return parsed.select("offset", "kind", "event_type", "category_id", "category_code", "price_text")


def line_value_by_category_code(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_event_lines(tables.event_lines(spark, sf))
    return agg.result_rows(agg.partial(prepare(parsed, CODE)))


# Strategies


def strategy_direct(spark: SparkSession, sf: str) -> DataFrame:
    """The route without pre-aggregation by name; in Spark it is the partial one."""
    return agg.result_rows(agg.aggregate(_purchases(spark, sf, ID), "v1"))


def strategy_partial(spark: SparkSession, sf: str) -> DataFrame:
    return agg.result_rows(agg.partial(_purchases(spark, sf, ID)))


def strategy_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = _dictionary(spark, sf)
    return agg.result_rows(agg.by_dictionary(_purchases(spark, sf, ID), dictionary))


def _packed(spark: SparkSession, sf: str, dictionary: DataFrame) -> DataFrame:
    return agg.pack(_purchases(spark, sf, ID, keep=("day",)), dictionary, "day", PACKED_IDS)


def strategy_packed(spark: SparkSession, sf: str) -> DataFrame:
    """One scan: the dictionary comes from the states that are packed."""
    daily = materialize(agg.partial_states(_purchases(spark, sf, ID, keep=("day",)), "day"))
    dictionary = materialize(dic.build_dictionary(daily.select("group_key").distinct()))
    return agg.result_rows(agg.merge_packed(agg.pack_states(daily, dictionary, "day", PACKED_IDS), dictionary))


def packed_entries(spark: SparkSession, sf: str) -> DataFrame:
    packed = _packed(spark, sf, _dictionary(spark, sf))
    return packed.select("day", "bucket", F.inline("entries"))


def packed_bucket_sizes(spark: SparkSession, sf: str) -> DataFrame:
    packed = _packed(spark, sf, _dictionary(spark, sf))
    return packed.select("day", "bucket", F.size("entries").alias("entries"))


def partial_states_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return agg.partial_states(_purchases(spark, sf, CODE, keep=("day",)), "day")


def merged_states(spark: SparkSession, sf: str) -> DataFrame:
    return agg.merge_states(partial_states_by_day(spark, sf))


def incremental_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The days merged one after another into a stored roll-up, the first of them twice."""
    daily = materialize(partial_states_by_day(spark, sf))
    days = [r["day"] for r in daily.select("day").distinct().orderBy("day").collect()]
    grown = Rollup(spark, new_shared_path(spark, "rollup"))
    for number, day in enumerate([*days, *days[:1]], 1):
        grown.merge(day, daily.where(F.col("day") == day))
        if number % 12 == 0:
            grown.compact()
    return agg.result_rows(grown.states())


def group_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return dic.build_dictionary(dic.counted_groups(_purchases(spark, sf, CODE)))


def dictionary_misses(spark: SparkSession, sf: str) -> DataFrame:
    """Full codes against a dictionary of top-level ones: every two-level code is a miss."""
    known = dic.build_dictionary(dic.counted_groups(_purchases(spark, sf, ROOT)))
    return dic.dictionary_misses(_purchases(spark, sf, CODE), known)


# Profile


def profile_group_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.group_counts(_purchases(spark, sf, ROOT))


def result_totals(spark: SparkSession, sf: str) -> DataFrame:
    return profile.result_totals(_states(spark, sf))


def record_reduction(spark: SparkSession, sf: str) -> DataFrame:
    """How far states per day, plain and packed, reduce the purchases."""
    states = agg.partial_states(_purchases(spark, sf, ID, keep=("day",)), "day")
    return profile.state_sizes(states, _packed(spark, sf, _dictionary(spark, sf)))


# Samples


def _sampled(spark: SparkSession, sf: str) -> DataFrame:
    placed = tables.events_as_raw(spark, sf).select(
        F.lit(SAMPLE_URI).alias("uri"), F.col("event_id").alias("offset"), "event_id", "event_type"
    )
    return sample.hash_sample(placed, SAMPLE_RATE, SAMPLE_SEED)


def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _sampled(spark, sf).select("event_id", "event_type")


def hash_sample_type_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _sampled(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# Quality


def _order_result(spark: SparkSession, sf: str) -> DataFrame:
    return agg.partial(prepare(tables.orders_as_events(spark, sf), ID))


def _damaged_result_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The orders result as lines, with a fault in some and some lines twice."""
    rows = agg.result_rows(_order_result(spark, sf)).withColumn("c", F.col("group_key").cast("bigint"))
    key, count = F.col("group_key"), F.col("purchase_count").cast("string")
    total, average = F.col("total_revenue"), F.col("average_revenue")
    number = F.col("c")

    def line(*cells: Column) -> Column:
        return F.concat_ws("\t", *cells)

    value = (
        F.when(number % 17 == 0, line(key, total, count, F.concat(average, F.lit("0"))))
        .when(number % 19 == 0, line(key, F.concat(F.lit("0"), total), count, average))
        .when(number % 23 == 0, line(key, total, F.lit("0"), average))
        .when(number % 29 == 0, line(key, total, count))
        .when(number % 31 == 0, line(F.lit(""), total, count, average))
        .otherwise(line(key, total, count, average))
    )
    copies = F.when(number % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(value.alias("value"), F.explode(copies).alias("copy")).select("value")


def result_violations(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_result_lines(_damaged_result_lines(spark, sf))
    return compare.result_violations(parsed).groupBy("violation").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("lines")
    )


def validated_result(spark: SparkSession, sf: str) -> DataFrame:
    """The orders result as lines, held against the number of orders."""
    parsed = parse_result_lines(writers.result_lines(_order_result(spark, sf)))
    return compare.validate_result(parsed, row_count(tables.read_table(spark, sf, "orders")))


def rejected_result(spark: SparkSession, sf: str) -> DataFrame:
    """The damaged orders result held against the number of orders."""
    parsed = parse_result_lines(_damaged_result_lines(spark, sf))
    checked = compare.validate_result(parsed, row_count(tables.read_table(spark, sf, "orders")), max_keys=10)
    return checked.select("too_many_groups", "valid")


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders placed twice by a customer with the same priority and status."""
    return compare.duplicate_keys(tables.orders_as_events(spark, sf), "category_id", "category_code")


def result_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The clean roll-up by code against that of the damaged events."""
    clean = agg.partial(prepare(purchases_only(tables.events_as_raw(spark, sf)), CODE))
    return compare.result_diff(clean, _states(spark, sf, CODE))


def _line_table(events: DataFrame) -> DataFrame:
    """Every column of the event as one text."""
    text = F.expr(manifest.row_text("kind", "event_id", "day", *EVENT_FIELDS))
    return events.select(F.col("day").alias("uri"), F.col("event_id").alias("offset"), text.alias("value"))


def _manifests(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """One entry per day of the clean events, and of the damaged ones."""
    clean = tables.events_as_raw(spark, sf).withColumn("kind", F.lit("EVENT"))
    dirty = tables.events_dirty(spark, sf)
    return (
        manifest.line_manifest(_line_table(clean)),
        manifest.line_manifest(_line_table(dirty)),
    )


def slice_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return _manifests(spark, sf)[1]


def input_drift(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.input_drift(*_manifests(spark, sf))


def repeated_line_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Slices that hold some lines twice, against slices that on even days hold as many others twice."""
    events = tables.events_as_raw(spark, sf).withColumn("kind", F.lit("EVENT"))
    number, odd = F.col("event_id") % 4, F.right("day", F.lit(2)).cast("int") % 2 == 1

    def doubled(which: Column, dropped: Column) -> DataFrame:
        copies = F.when(which, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        rows = events.where(~dropped).withColumn("copy", F.explode(copies))
        return manifest.line_manifest(_line_table(rows).withColumn("offset", F.lit(0).cast("bigint")))

    before = doubled(number == 0, number == 1)
    after = doubled((number == 0) | (number == 1), ((number == 0) & ~odd) | ((number == 1) & odd))
    return manifest.input_drift(before, after)


#: Positions are event ids here, so that blocks are small. Beyond 1,048,576 ids a day has several nodes at the top level.
BLOCKS = digests.Shape(block_bytes=256, fanout=8, height=4, forest=True)


def block_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The tree of block digests over the damaged events of every day."""
    return digests.tree(_line_table(tables.events_dirty(spark, sf)), BLOCKS)


def block_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The blocks in which the damaged events differ from the clean ones."""
    clean = tables.events_as_raw(spark, sf).withColumn("kind", F.lit("EVENT"))
    trees = [digests.tree(_line_table(t), BLOCKS) for t in (clean, tables.events_dirty(spark, sf))]
    return digests.tree_drift(*trees, BLOCKS)


def manifest_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.manifest_fingerprint(_manifests(spark, sf)[1])


def provenance_match(spark: SparkSession, sf: str) -> DataFrame:
    left, right = (manifest.manifest_fingerprint(m) for m in _manifests(spark, sf))
    return manifest.provenance_match(left, right, "input_fingerprint", "policy_hash", "schema_version")


def dictionary_checksum(spark: SparkSession, sf: str) -> DataFrame:
    return dic.dictionary_checksum(group_dictionary(spark, sf), F.lit("events"), CODE)


def dictionary_digest(spark: SparkSession, sf: str) -> DataFrame:
    return dic.dictionary_digest(group_dictionary(spark, sf), F.lit("events"), CODE)


def dictionary_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of eight ids each of the code dictionary, and those above."""
    return dic.dictionary_tree(group_dictionary(spark, sf), digests.Shape(block_bytes=8, fanout=4, height=5))


def _damaged_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """The code dictionary with repeated, swapped, overlong and unsafe entries."""
    entry, key = F.col("id"), F.col("group_key")
    damaged = (
        F.when(entry % 10 == 3, F.concat(key, F.lit("\tx")))
        .when(entry % 10 == 5, F.rpad(key, 300, "z"))
        .when(entry % 10 == 7, F.lit("d0"))
        .when(entry % 10 == 9, F.lit(""))
        .otherwise(key)
    )
    return group_dictionary(spark, sf).select("id", damaged.alias("group_key"))


def dictionary_violations(spark: SparkSession, sf: str) -> DataFrame:
    return dic.dictionary_violations(_damaged_dictionary(spark, sf)).select("id", "rule")


def state_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Daily states after a careless correction: sums shifted down, counts of quiet groups cleared."""
    states = partial_states_by_day(spark, sf)
    count = F.col("purchase_count")
    damaged = states.select(
        "day",
        "group_key",
        (F.col("sum_minor") - 1000).alias("sum_minor"),
        F.when(count == 1, F.lit(0)).when(count == 2, F.lit(-2)).otherwise(count).cast("bigint").alias("purchase_count"),
    )
    return compare.state_violations(damaged, "day", "group_key")


def packed_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Packed rows whose entries lost one purchase each."""
    packed = _packed(spark, sf, _dictionary(spark, sf))
    lowered = packed.select("day", "bucket", F.inline("entries")).groupBy("day", "bucket").agg(
        F.collect_list(
            F.struct("id", "sum_minor", (F.col("purchase_count") - 1).alias("purchase_count"))
        ).alias("entries")
    )
    found = compare.packed_violations(lowered, "day", max_entries=PACKED_IDS - 2)
    return found.groupBy("day", "bucket", "rule").agg(F.count(F.lit(1)).alias("n"))


def preflight_file_statistics(spark: SparkSession, sf: str) -> DataFrame:
    lines = tables.event_lines(spark, sf)
    return preflight.file_statistics(lines, CODE, position=F.col("offset"), starts_file=F.lit(True))


def preflight_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    return preflight.rule_counts(preflight_file_statistics(spark, sf))


def preflight_totals(spark: SparkSession, sf: str) -> DataFrame:
    return preflight.preflight_totals(preflight_file_statistics(spark, sf))


def preflight_first_errors(spark: SparkSession, sf: str) -> DataFrame:
    return preflight.first_errors(preflight.line_violations(tables.event_lines(spark, sf), CODE))


def damaged_line_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = preflight.line_violations(tables.damaged_lines(spark, sf), CODE)
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def damaged_first_errors(spark: SparkSession, sf: str) -> DataFrame:
    return preflight.first_errors(preflight.line_violations(tables.damaged_lines(spark, sf), CODE))


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    tallied = profile.tally(prepare(parse_event_lines(tables.event_lines(spark, sf)), CODE))
    return compare.reconciliation(tallied, preflight_file_statistics(spark, sf), _states(spark, sf, CODE))


# Sinks and files


def result_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The orders result written as a result table and read back."""
    path = new_shared_path(spark, "result")
    writers.write_result(_order_result(spark, sf), path)
    parsed = parse_result_lines(read_result_lines(spark, path))
    return parsed.select("group_key", "sum_minor", "purchase_count", "total_revenue", "average_revenue")


def export_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the CSV export, read back from one file."""
    path = new_shared_path(spark, "export") + ".csv"
    writers.export_csv(agg.result_rows(_states(spark, sf, CODE)), path, single=True)
    lines = spark.read.option("lineSep", "\r\n").text(path)
    return lines.select(F.monotonically_increasing_id().alias("position"), "value")


def csv_file_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as CSV files and read back with offsets; each line must begin where the one before it ends."""
    parsed = parse_event_lines(scan_lines(spark, _written_events(spark, sf, broken=True)))
    size = F.octet_length("value") + 1
    before = F.lag(F.col("offset") + size).over(Window.partitionBy("uri").orderBy("offset"))
    placed = parsed.select("kind", size.alias("bytes"), (F.coalesce(before, F.lit(0)) != F.col("offset")).alias("stray"))
    rows = placed.where(F.col("kind") != "HEADER").groupBy("kind")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.count_if("stray").alias("gaps"))


def _written_events(spark: SparkSession, sf: str, broken: bool) -> list:
    """The dirty events as CSV files, with or without their malformed lines."""
    lines = tables.event_lines(spark, sf)
    path = new_shared_path(spark, "events")
    writers.write_sample(lines if broken else lines.where("offset % 503 <> 0 OR offset % 499 = 0"), path)
    return list_csv(spark, path)


def stored_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest of event files written, read back, and its files found and digested anew."""
    files = _written_events(spark, sf, broken=True)
    path = new_shared_path(spark, "manifest") + ".json"
    writers.write_artifact(runs.manifest_entries(manifest.file_manifest(spark, files)), path)
    named, entries = runs.files_of_manifest(spark, path)
    drifted = row_count(manifest.input_drift(entries, manifest.file_manifest(spark, named)))
    lines = F.sum("bytes") - F.count(F.lit(1)) * (len(HEADER_LINE) + 1)
    return entries.agg(lines.alias("bytes"), F.count_if(~F.col("uri").endswith(".csv")).alias("strays")).withColumn(
        "drifted", drifted
    )


def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """Checked runs over event files by three routes and one that fails on malformed lines, by their records."""
    files, out = _written_events(spark, sf, broken=False), new_shared_path(spark, "runs")
    profiled = runs.run_profile(spark, files, ID)
    runs.write_profile(profiled, f"{out}/profile")
    paths = []
    for variant in ("v2", "v4", "v5"):
        runs.run_aggregate(spark, files, f"{out}/{variant}", ID, variant, profiled.dictionary)
        paths.append(f"{out}/{variant}/_run-manifest.json")
    paths.append(f"{out}/failed.json")
    with contextlib.suppress(runs.RunFailed):
        runs.run_aggregate(spark, _written_events(spark, sf, broken=True), f"{out}/v1", ID, "v1", failed_record=paths[-1])
    records = runs.read_records(spark, paths, runs.read_profiles(spark, [f"{out}/profile"]))
    return records.select(
        "variant",
        "effective_variant",
        "success",
        "purchases",
        "malformed",
        "groups",
        "total_sum_minor",
        F.col("error").isNotNull().alias("has_error"),
        (F.col("profile_ms") > 0).alias("profiled"),
    )


# Workloads and run records


def synthetic_skew(spark: SparkSession, sf: str) -> DataFrame:
    """A skewed workload with an event per order, rolled up by its code."""
    orders = tables.read_table(spark, sf, "orders").select("o_orderkey")
    events = synthetic_events(orders, "o_orderkey", groups=32, mode="skew", skew=0.9, purchase_rate=0.5)
    return agg.result_rows(agg.partial(prepare(events, CODE)))


def synthetic_uniform(spark: SparkSession, sf: str) -> DataFrame:
    orders = tables.read_table(spark, sf, "orders").select("o_orderkey")
    events = synthetic_events(orders, "o_orderkey", groups=100, purchase_rate=0.2)
    return agg.result_rows(agg.partial(prepare(events, ID)))


def synthetic_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    """A group per order: as many groups as rows."""
    orders = tables.read_table(spark, sf, "orders").select("o_orderkey")
    events = synthetic_events(orders, "o_orderkey", groups=1, mode="cardinality", purchase_rate=1.0)
    return agg.partial(prepare(events, ID))


def _run_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as run records: type gives the status, user the variant, amount the times."""
    events = tables.read_table(spark, sf, "events")
    variant = F.concat(F.lit("v"), (F.col("user_id") % 5 + 1).cast("string"))
    job = F.round(F.col("value") * 100).cast("bigint")
    return events.select(
        variant.alias("variant"),
        F.upper(variant).alias("effective_variant"),
        (F.col("event_type") != "error").alias("success"),
        (F.col("event_type") == "signup").alias("warmup"),
        job.alias("job_ms"),
        (job + F.col("user_id")).alias("end_to_end_ms"),
        F.when(variant != "v5", F.when(variant == "v4", F.lit(1085)).otherwise(F.lit(0))).alias("profile_ms"),
        (F.col("event_id") * 10).alias("shuffle_bytes"),
        F.col("event_id").alias("map_records"),
        F.when(variant != "v2", F.col("user_id")).alias("reduce_records"),
    )


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary.run_summary(_run_records(spark, sf), ["v1", "v2", "v3", "v4", "v5"], repeats=3)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        purchase_value_by_category_id,
        purchase_value_by_category_code,
        purchase_value_by_category_root,
        order_value_by_customer,
        order_value_by_priority,
        line_value_by_part,
        line_value_by_brand,
        event_reason_counts,
        event_reason_counts_by_root,
        missing_code_count,
        prepared_purchases,
        event_tally,
        money_parse,
        money_average,
        sample_buckets,
        parsed_event_lines,
        projected_event_lines,
        line_value_by_category_code,
        strategy_direct,
        strategy_partial,
        strategy_dictionary,
        strategy_packed,
        packed_entries,
        packed_bucket_sizes,
        partial_states_by_day,
        merged_states,
        incremental_rollup,
        group_dictionary,
        dictionary_misses,
        profile_group_counts,
        result_totals,
        record_reduction,
        hash_sample,
        hash_sample_type_shares,
        result_violations,
        validated_result,
        rejected_result,
        duplicate_keys,
        result_diff,
        slice_manifest,
        input_drift,
        repeated_line_drift,
        block_manifest,
        block_drift,
        manifest_fingerprint,
        provenance_match,
        dictionary_checksum,
        dictionary_digest,
        dictionary_ranges,
        dictionary_violations,
        state_violations,
        packed_violations,
        preflight_file_statistics,
        preflight_rule_counts,
        preflight_totals,
        preflight_first_errors,
        damaged_line_rules,
        damaged_first_errors,
        reconciliation,
        result_roundtrip,
        export_sorted,
        csv_file_offsets,
        stored_manifest,
        run_records,
        synthetic_skew,
        synthetic_uniform,
        synthetic_cardinality,
        run_summary,
    )
}
