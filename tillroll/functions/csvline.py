"""One physical line to event fields."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.functions.text import strip_bom, strip_cr, trim_blanks
from tillroll.model import (
    EVENT_COLUMNS,
    HEADER_LINE,
    KIND_EVENT,
    KIND_HEADER,
    KIND_MALFORMED,
    MAX_LINE_BYTES,
)
from tillroll.session import select_in_steps

_N = len(EVENT_COLUMNS)
# Possessive quantifiers never backtrack, so a 64 KiB field cannot exhaust the regex stack.
_QUOTED = r'"([^"]*+(?:""[^"]*+)*+)"\p{javaWhitespace}*+'
_BARE = r'([^",][^,]*+|)'
# The line is matched behind an added comma, so that every field starts with one.
_FIELD = f",(?:{_QUOTED}|{_BARE})"
_RECORD = rf"\A(?:{_FIELD}){{{_N}}}\z"
# A doubled quote inside quoted text, found from the LF before it or right behind another one.
_DOUBLED = r'(\G(?!\A)|\n)([^"\r\n]*+)""'
_QUOTED_HEADER = r"\A" + ",".join(rf'(?:{c}|"{c}"\p{{javaWhitespace}}*+)' for c in EVENT_COLUMNS) + r"\z"


def parse_event_lines(lines: DataFrame, fast_path: bool = True) -> DataFrame:
    """Add ``kind`` and the four used fields to a frame with a ``value`` column of lines.

    Whole lines are judged before any field is taken. Reading the text as CSV columns would hide
    bad records as soon as the optimizer prunes a column. ``fast_path`` splits quote-free lines at
    their commas; without it every line takes the quoted route. Both give the same rows.
    """
    kept = [f"`{c}`" for c in lines.columns]
    quoted = """contains(_body, '"')""" if fast_path else "true"
    # A line holds neither LF nor CR by now, so they can set off the fields, and what was inside
    # quotes from what was not: LF, quoted text, CR, bare text.
    marked = rf"regexp_replace(concat(',', _body), r'{_FIELD}', '\n$1\r$2')"
    unquoted = rf"""replace(regexp_replace({marked}, r'{_DOUBLED}', '$1$2"'), '\r', '')"""
    split = rf"slice(split({unquoted}, '\n', -1), 2, {_N})"
    field = {name: f"_fields[{EVENT_COLUMNS.index(name)}]" for name in EVENT_COLUMNS}
    # Separate selects keep each step computed once: Spark merges them only where that is free.
    return select_in_steps(
        lines,
        ["*", f"{strip_cr('value')} AS _line"],
        [
            *kept,
            f"""CASE WHEN octet_length(_line) <= {MAX_LINE_BYTES} AND NOT contains(_line, '\\r')
            AND NOT contains(_line, '\\n') AND is_valid_utf8(_line) THEN {strip_bom("_line")} END AS _body""",
        ],
        ["*", f"{quoted} AS _quoted"],
        [
            "*",
            f"""if(_quoted, CASE WHEN concat(',', _body) RLIKE r'{_RECORD}' THEN {split} END,
            split(_body, ',', -1)) AS _fields""",
        ],
        [
            "*",
            f"""CASE WHEN _fields IS NULL OR size(_fields) <> {_N} THEN '{KIND_MALFORMED}'
            WHEN if(_quoted, _body RLIKE r'{_QUOTED_HEADER}', _body = '{HEADER_LINE}') THEN '{KIND_HEADER}'
            ELSE '{KIND_EVENT}' END AS kind""",
        ],
        # Null for headers and malformed lines, and so are the fields taken from it.
        [*kept, "kind", f"if(kind = '{KIND_EVENT}', _fields, NULL) AS _fields"],
        [
            *kept,
            "kind",
            f"{trim_blanks(field['event_type'])} AS event_type",
            f"{field['category_id']} AS category_id",
            f"{field['category_code']} AS category_code",
            f"{field['price']} AS price_text",
        ],
    )
