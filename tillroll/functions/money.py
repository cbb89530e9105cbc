"""Exact money in minor units: text to ``bigint``, ``bigint`` to text, half-up averages."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame

from tillroll.functions.text import trim_blanks
from tillroll.session import select_in_steps

# The common spelling: digits that need only lose their point.
_PLAIN = r"\A[0-9]{1,16}\.[0-9]{2}\z"
# Amounts whose digits beyond the second decimal are zeros, so that a cast drops nothing.
_EXACT = r"\A(?:\+?(?=\.?[0-9])[0-9]*(?:\.[0-9]{0,2}0*)?|-(?=\.?0)0*(?:\.0*)?)\z"
_SCIENTIFIC = r"\A[+-]?(?:([0-9]+)\.?([0-9]*)|\.([0-9]+))[eE]([+-]?[0-9]+)\z"
_WIDE_DIGITS = [c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c) == "Nd"]
_WIDE_FROM = "".join(_WIDE_DIGITS)
_WIDE_TO = "".join(str(unicodedata.digit(c)) for c in _WIDE_DIGITS)
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def minor_steps(text: str, name: str) -> list[list[str]]:
    """Selects that add ``name``: minor units of a decimal text, or null unless it is an exact amount of at least 0.

    A cast to a decimal would round ``12.301`` instead of refusing it, so a pattern first makes sure
    that nothing is lost. Signs, exponents and digits of other scripts are understood.

    The steps are columns of their own (``_name_text`` and so on, for the caller to leave behind),
    each computed once, because the common row needs only the first. As one expression the
    generated method grows beyond what the JVM will compile.
    """
    plain, odd, digits, shift = (f"_{name}_{part}" for part in ("text", "odd", "digits", "shift"))
    length = f"(length({digits}) + {shift})"
    dropped = f"(length({digits}) - length(rtrim('0', {digits})) + {shift})"
    spelled = f"translate({trim_blanks(plain)}, '{_WIDE_FROM}', '{_WIDE_TO}')"
    # An exponent moves the digits by ``shift`` places; it is null when there is none or it is no int.
    # Moving adds zeros behind the digits or takes digits away there, of which only zeros may go.
    # The resulting scale must fit an int, even for a zero amount.
    return [
        ["*", f"{text} AS {plain}"],
        ["*", f"if({plain} RLIKE r'{_PLAIN}', NULL, {spelled}) AS {odd}"],
        [
            "*",
            f"ltrim('0', regexp_replace({odd}, r'{_SCIENTIFIC}', '$1$2$3')) AS {digits}",
            f"CAST(try_cast(regexp_extract({odd}, r'{_SCIENTIFIC}', 4) AS INT) AS BIGINT) + 2"
            f" - length(regexp_replace({odd}, r'{_SCIENTIFIC}', '$2$3')) AS {shift}",
        ],
        [
            "*",
            f"""CASE
            WHEN {odd} IS NULL THEN CAST(replace({plain}, '.', '') AS BIGINT)
            WHEN {odd} RLIKE r'{_EXACT}' THEN try_cast(try_cast({odd} AS DECIMAL(38,2)) * 100 AS BIGINT)
            WHEN {shift} IS NULL OR {shift} NOT BETWEEN {2 - _INT_MAX} AND {2 - _INT_MIN} THEN NULL
            WHEN {digits} = '' THEN 0
            WHEN NOT startswith({odd}, '-') AND {length} <= 19 AND {dropped} >= 0
                THEN try_cast(rpad({digits}, CAST({length} AS INT), '0') AS BIGINT)
            END AS {name}""",
        ],
    ]


def with_minor(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the minor units of a decimal text, by :func:`minor_steps`."""
    return select_in_steps(rows, *minor_steps(text, name))


def format_minor(minor: str) -> str:
    """Plain text with two decimals."""
    return f"CAST(CAST(CAST({minor} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(22,2)) AS STRING)"


def average_minor(total: str, count: str) -> str:
    """``total / count`` rounded half up to a whole minor unit; null unless ``count`` is positive.

    The remainder is below ``count``, so no intermediate value leaves the range of ``bigint``.
    """
    return (
        f"CASE WHEN {count} > 0 AND {total} >= 0 "
        f"THEN {total} div {count} + if(2 * ({total} % {count}) >= {count}, 1, 0) END"
    )
