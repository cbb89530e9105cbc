"""Event frames made from ordinary tables, with whole tables as their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.model import EVENT_COLUMNS, HEADER_LINE
from tillroll.session import select_in_steps


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def amount_text(amount: str) -> str:
    """A number of whole cents as two-decimal text; one with a fraction of a cent fails the job."""
    cents = f"CAST({amount} AS DECIMAL(18,2))"
    fraction = f"abs({amount} - CAST({cents} AS DOUBLE)) > 0.000001"
    return f"if({fraction}, raise_error('An amount has a fraction of a cent'), CAST({cents} AS STRING))"


def events_as_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the nine-column shape, with ``event_id``, ``day`` and the used fields.

    Category ``k`` comes from the properties; codes are missing, top-level or two-level by ``k``.
    """
    columns = [
        "event_id",
        "left(CAST(ts AS STRING), 10) AS day",
        "concat(left(CAST(ts AS STRING), 19), ' UTC') AS event_time",
        "event_type",
        "CAST(event_id AS STRING) AS product_id",
        "category_id",
        "CASE WHEN k % 10 = 0 THEN '' WHEN k % 10 = 1 THEN concat('d', k % 7) "
        "ELSE concat('d', k % 7, '.c', k) END AS category_code",
        "'brand' AS brand",
        f"{amount_text('value')} AS price_text",
        "CAST(user_id AS STRING) AS user_id",
        "'' AS user_session",
    ]
    return select_in_steps(
        read_table(spark, sf_dir, "events"),
        ["*", "get_json_object(props, '$.k') AS category_id"],
        ["*", "CAST(category_id AS INT) AS k"],
        columns,
    )


def events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events with faults at fixed places, so that every outcome occurs.

    ``kind`` marks the rows that stand for a header or a damaged line; those faults replace the
    whole row and win over the others.
    """
    return events_as_raw(spark, sf_dir).selectExpr(
        "event_id",
        "day",
        "CASE WHEN event_id % 499 = 0 THEN 'HEADER' WHEN event_id % 503 = 0 THEN 'MALFORMED' ELSE 'EVENT' END AS kind",
        "event_time",
        "event_type",
        "product_id",
        "if(event_id % 89 = 0, '', category_id) AS category_id",
        "if(event_id % 79 = 0, '.x', category_code) AS category_code",
        "brand",
        "CASE WHEN event_id % 97 = 0 THEN 'NaN' WHEN event_id % 101 = 0 THEN '12.301' "
        "WHEN event_id % 83 = 0 THEN '-1' ELSE price_text END AS price_text",
        "user_id",
        "user_session",
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uri, offset, value``: the dirty events as CSV lines of one virtual file per day.

    Every seventh line quotes its brand, with a comma and doubled quotes inside, and every eleventh
    ends in a carriage return.
    """
    brand = """if(event_id % 7 = 0, '"say ""hi"", twice"', brand)"""
    columns = [{"brand": brand, "price": "price_text"}.get(c, c) for c in EVENT_COLUMNS]
    # A null is left out of the line: a malformed one lacks its last column.
    columns[-1] = f"if(kind = 'MALFORMED', NULL, {columns[-1]})"
    line = f"if(kind = 'HEADER', '{HEADER_LINE}', concat_ws(',', {', '.join(columns)}))"
    return events_dirty(spark, sf_dir).selectExpr(
        "concat('events/day=', day) AS uri",
        "event_id AS offset",
        f"concat({line}, if(event_id % 11 = 0, '\\r', '')) AS value",
    )


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uri, offset, value``: the clean events as CSV lines with one of every fault a line can have.

    Some lines are too long, hold a byte that is no UTF-8, open a quote without closing it or have a
    code that is too long; others start with a byte order mark, which is no fault.
    """
    cells = {
        "brand": "CASE WHEN event_id % 211 = 0 THEN repeat('x', 70000) WHEN event_id % 227 = 0 THEN '\"open' ELSE brand END",
        "category_code": "if(event_id % 229 = 0, repeat('c', 300), category_code)",
        "price": "price_text",
    }
    line = f"concat_ws(',', {', '.join(cells.get(c, c) for c in EVENT_COLUMNS)})"
    return events_as_raw(spark, sf_dir).selectExpr(
        "concat('events/day=', day) AS uri",
        "event_id + 1 AS offset",
        f"""CASE WHEN event_id % 223 = 0 AND event_id % 211 <> 0 THEN CAST(concat(CAST({line} AS BINARY), X'FF') AS STRING)
        WHEN event_id % 233 = 0 THEN concat('\ufeff', {line}) ELSE {line} END AS value""",
    )


def lineitem_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a purchase of its part at its extended price."""
    return read_table(spark, sf_dir, "lineitem").selectExpr(
        "'purchase' AS event_type",
        "CAST(l_partkey AS STRING) AS category_id",
        "'' AS category_code",
        f"{amount_text('l_extendedprice')} AS price_text",
    )


def orders_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a purchase by its customer, coded by priority and status."""
    return read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "'purchase' AS event_type",
        "CAST(o_custkey AS STRING) AS category_id",
        "concat_ws('.', o_orderpriority, o_orderstatus) AS category_code",
        f"{amount_text('o_totalprice')} AS price_text",
    )
