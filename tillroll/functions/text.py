"""SQL fragments for the trimming, length and ordering rules of the event contract.

The functions of this package take and return SQL text. A row passes through dozens of small
steps, and building those as Column objects costs a call into the JVM each.
"""

from __future__ import annotations

# Every character up to U+0020, as a SQL string literal.
_BLANKS = "'" + "".join(f"\\u{code:04x}" for code in range(0x21)) + "'"


def trim_blanks(text: str) -> str:
    """Strip every character up to U+0020 from both ends (``trim`` strips spaces only)."""
    return f"btrim({text}, {_BLANKS})"


def strip_cr(line: str) -> str:
    """Drop one trailing carriage return."""
    return f"if(endswith({line}, '\\r'), left({line}, length({line}) - 1), {line})"


def strip_bom(line: str) -> str:
    """Drop one leading byte order mark."""
    return f"if(startswith({line}, '\\ufeff'), substr({line}, 2), {line})"


def has_line_break_or_tab(text: str) -> str:
    return f"(contains({text}, '\\t') OR contains({text}, '\\n') OR contains({text}, '\\r'))"


def utf16_order(text: str) -> str:
    """Sort key that orders by UTF-16 code units; plain string order compares UTF-8 bytes."""
    return f"encode({text}, 'UTF-16BE')"


def utf16_length(text: str) -> str:
    """Length in UTF-16 code units."""
    return f"(octet_length({utf16_order(text)}) div 2)"


def csv_key_field(text: str) -> str:
    """The leading field of an RFC 4180 record, quoted only where a reader needs it.

    That is: when it is empty; when it holds a comma, quote, CR or LF; when it starts with a
    character up to ``#`` or above ``~``; or when it ends in a blank.
    """
    needs_quotes = rf"""{text} RLIKE r'[",\r\n]|\A[\x00-#]|\A[^\x00-~]|[\x00-\x20]\z'"""
    return f"""if({text} = '' OR {needs_quotes}, concat('"', replace({text}, '"', '""'), '"'), {text})"""
