"""Reading result tables: header-less TSV with group, total, count and average."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.money import average_minor, format_minor, minor_steps
from tillroll.session import select_in_steps
from tillroll.sources.files import InputError, hadoop_path

# Counts are written without a leading plus or blanks, but a reader of longs takes a sign.
_CELLS = ("group_key", "total_revenue", "_count", "average_revenue")
_LONG = r"\A[+-]?[0-9]+\z"


def read_result_lines(spark: SparkSession, directory: str) -> DataFrame:
    """The lines of all part files. At least one part must exist, though it may be empty."""
    jpath, fs = hadoop_path(spark, directory)
    parts = fs.exists(jpath) and [s for s in fs.listStatus(jpath) if s.getPath().getName().startswith("part-")]
    if not parts:
        raise InputError(f"{directory} holds no part of a result")
    return spark.read.text(directory, pathGlobFilter="part-*")


def parse_result_lines(lines: DataFrame) -> DataFrame:
    """Add the four columns, the amounts they hold and ``violation``, the first rule a line breaks.

    The writer of a result knows one spelling only, so the total must be canonical and the average
    must equal the one recomputed from total and count.
    """
    kept = [f"`{c}`" for c in lines.columns]
    return select_in_steps(
        lines,
        ["*", "split(value, '\\t', -1) AS _cells"],
        [*kept, *(f"if(size(_cells) = 4, _cells[{i}], NULL) AS {name}" for i, name in enumerate(_CELLS))],
        *minor_steps("total_revenue", "sum_minor"),
        [
            *kept,
            "group_key",
            "total_revenue",
            "average_revenue",
            "sum_minor",
            f"if(_count RLIKE r'{_LONG}', try_cast(_count AS BIGINT), NULL) AS purchase_count",
        ],
        [
            "*",
            f"""CASE
            WHEN group_key IS NULL THEN 'columns'
            WHEN group_key = '' THEN 'empty_key'
            WHEN sum_minor IS NULL THEN 'total'
            WHEN purchase_count IS NULL OR purchase_count <= 0 THEN 'count'
            WHEN total_revenue <> {format_minor("sum_minor")} THEN 'total'
            WHEN average_revenue <> {format_minor(average_minor("sum_minor", "purchase_count"))} THEN 'average'
            END AS violation""",
        ],
    )
