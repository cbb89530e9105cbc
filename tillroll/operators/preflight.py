"""Rules a set of event files must meet before anything is computed from it."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import model as M
from tillroll.functions.csvline import parse_event_lines
from tillroll.model import GroupMode
from tillroll.operators import digests
from tillroll.operators.aggregate import exact_sum
from tillroll.operators.prepare import prepare
from tillroll.sources.files import InputFile, scan_splits

# The faults a single line can have. At most one applies, judged in this order.
LINE_FAULTS = ("line_too_long", "invalid_utf8", "malformed_line", "group_field_too_long")
MISSING_HEADER = "missing_header"
NO_HEADER = "no_header"


def _with_fault(lines: DataFrame, mode: GroupMode) -> DataFrame:
    """Parsed lines with their ``fault``, if any.

    The group field is judged as it stands in the file: before trimming, on every event of any
    type, and with the full code even when only its root is used.
    """
    field = "category_id" if mode is GroupMode.CATEGORY_ID else "category_code"
    return parse_event_lines(lines).selectExpr(
        "*",
        f"""CASE WHEN octet_length(value) > {M.MAX_LINE_BYTES} THEN 'line_too_long'
            WHEN kind = '{M.KIND_MALFORMED}' THEN if(is_valid_utf8(value), 'malformed_line', 'invalid_utf8')
            WHEN octet_length({field}) > {M.MAX_KEY_BYTES} THEN 'group_field_too_long' END AS fault""",
    )


def line_violations(lines: DataFrame, mode: GroupMode | str) -> DataFrame:
    """``uri, offset, rule`` for every broken rule, from lines that carry their offset.

    The first line of a file is the one at offset 0. A line that is not a header there breaks
    ``missing_header`` besides the rules of its own.
    """
    headless = F.when((F.col("offset") == 0) & (F.col("kind") != M.KIND_HEADER), MISSING_HEADER)
    rules = F.array_compact(F.array(headless, F.col("fault")))
    return _with_fault(lines, GroupMode.of(mode)).select("uri", "offset", F.explode(rules).alias("rule"))


def first_errors(violations: DataFrame, limit: int = M.MAX_REPORTED_ERRORS) -> DataFrame:
    """The first messages of a report, in file and line order."""
    return violations.orderBy("uri", "offset", "rule").limit(limit)


def file_statistics(
    lines: DataFrame, mode: GroupMode | str, position: Column, starts_file: Column, listed: DataFrame | None = None
) -> DataFrame:
    """One row per file: lines, valid purchases, broken rules, and whether it opens with a header.

    ``position`` orders the lines of a file and ``starts_file`` marks rows that can be its first.
    Position and header flag share one number, whose minimum says what the first line was; all
    aggregates are plain numbers, so a few rows per file and task are all that is shuffled. Files
    named in ``listed`` get a row even if they hold no line.
    """
    mode = GroupMode.of(mode)
    faulty = _with_fault(lines.withColumn("_position", F.when(starts_file, position)), mode)
    prepared = prepare(faulty, mode, keep=("uri", "_position", "fault"))
    outcome = F.coalesce("fault", F.when(F.col("reason") == M.VALID_PURCHASE, "valid_purchases"), F.lit("other"))
    opening = F.col("_position") * 2 + (F.col("reason") != M.HEADER).cast("bigint")
    counted = prepared.select("uri", outcome.alias("outcome"), opening.alias("opening"))
    if listed is not None:
        # No line has the outcome null.
        counted = counted.unionByName(listed.selectExpr("uri", "CAST(NULL AS STRING) AS outcome", "CAST(NULL AS BIGINT) AS opening"))
    return counted.groupBy("uri").agg(
        F.count("outcome").alias("lines"),
        *(F.count_if(F.col("outcome") == name).alias(name) for name in ("valid_purchases", *LINE_FAULTS)),
        F.expr("coalesce(min(opening) % 2 = 0, false)").alias("has_header"),
    )


def tally_files(spark: SparkSession, files: Sequence[InputFile], mode: GroupMode | str) -> DataFrame:
    """Everything a run needs to know of its lines, from one scan.

    A row per file (and region of it), fault, outcome and group: ``n, sum_minor, missing_code``, the
    sums of :mod:`digests` over the lines and ``opening``, which says what the first line of the
    file was. :func:`statistics_of` rolls it up to preflight statistics, :func:`outcomes_of` to a
    digest; outcome counts and group states are plain sums over it.
    """
    starts = F.when(F.col("split_start") == 0, F.monotonically_increasing_id())
    region = F.expr(f"split_start div {digests.REGION_BYTES}")
    lines = scan_splits(spark, files).withColumns({"_position": starts, "_region": region})
    faulty = _with_fault(lines, GroupMode.of(mode))
    prepared = prepare(faulty, mode, keep=("uri", "_position", "_region", "fault", "value"))
    opening = F.col("_position") * 2 + (F.col("reason") != M.HEADER).cast("bigint")
    placed = prepared.withColumn("opening", opening)
    keep = ("uri", "_region", "fault", "reason", "group_key", "price_minor", "missing_code", "opening")
    hashed = digests.with_quick_words(placed, "value", keep)
    return hashed.groupBy("uri", "_region", "fault", "reason", "group_key").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum("price_minor").alias("sum_minor"),
        F.count_if("missing_code").alias("missing_code"),
        F.min("opening").alias("opening"),
        *digests.word_sums(),
    )


def outcomes_of(tallied: DataFrame) -> tuple[dict[str, int], str]:
    """Lines per outcome, and a digest of all lines of all files.

    The digest does not depend on the order of the lines, and counts repeated ones as often as they occur; a result is a
    function of just that. The input was read for it by the scan that made the tally.
    """
    rows = tallied.groupBy("reason").agg(exact_sum("n").alias("n"), *digests.merged_words()).collect()
    sums = [sum(int(r[w]) for r in rows) % (1 << 64) for w in digests.WORDS]
    text = ":".join(map(str, [sum(r["n"] for r in rows), *sums]))
    return {r["reason"]: r["n"] for r in rows}, hashlib.sha256(text.encode()).hexdigest()


def statistics_of(tallied: DataFrame, files: Sequence[InputFile]) -> DataFrame:
    """:func:`inspect_files` from the tally, with a row for every file."""
    listed = tallied.sparkSession.createDataFrame([(f.uri,) for f in files], "uri string")
    rows = tallied.select("uri", "fault", "reason", "n", "opening").unionByName(
        listed.selectExpr("uri", "NULL AS fault", "'' AS reason", "0L AS n", "CAST(NULL AS BIGINT) AS opening")
    )
    counts = {"valid_purchases": f"fault IS NULL AND reason = '{M.VALID_PURCHASE}'"}
    counts |= {name: f"fault <=> '{name}'" for name in LINE_FAULTS}
    return rows.groupBy("uri").agg(
        F.sum("n").alias("lines"),
        *(F.expr(f"sum(if({test}, n, 0))").alias(name) for name, test in counts.items()),
        F.expr("coalesce(min(opening) % 2 = 0, false)").alias("has_header"),
    )


def rule_counts(statistics: DataFrame) -> DataFrame:
    """``uri, rule, n`` for the rules a file breaks.

    A file with lines but no header at its start breaks ``missing_header`` and ``no_header``; an
    empty one only the latter.
    """
    counts = ", ".join(f"'{name}', {name}" for name in LINE_FAULTS)
    headers = (
        f"'{MISSING_HEADER}', CAST(NOT has_header AND lines > 0 AS BIGINT), '{NO_HEADER}', CAST(NOT has_header AS BIGINT)"
    )
    return statistics.selectExpr("uri", f"explode(map({counts}, {headers})) AS (rule, n)").where("n > 0")


def preflight_totals(statistics: DataFrame) -> DataFrame:
    """Files, lines, valid purchases and broken rules over the whole input, as one row."""
    header_errors = "CASE WHEN has_header THEN 0 WHEN lines > 0 THEN 2 ELSE 1 END"
    counted = statistics.selectExpr("*", f"{' + '.join(LINE_FAULTS)} + {header_errors} AS errors")
    return counted.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(exact_sum("lines"), F.lit(0)).alias("lines"),
        F.coalesce(exact_sum("valid_purchases"), F.lit(0)).alias("valid_purchases"),
        F.coalesce(exact_sum("errors"), F.lit(0)).alias("errors"),
    )


def inspect_files(spark: SparkSession, files: Sequence[InputFile], mode: GroupMode | str) -> DataFrame:
    """:func:`file_statistics` of event files, with a row for every file, empty ones included.

    One JVM-only pass; byte offsets are not needed. The rows of a task keep file order, so the
    generated id orders the lines of the split that opens a file.
    """
    return file_statistics(
        scan_splits(spark, files),
        mode,
        position=F.monotonically_increasing_id(),
        starts_file=F.col("split_start") == 0,
        listed=spark.createDataFrame([(f.uri,) for f in files], "uri string"),
    )
