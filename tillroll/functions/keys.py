"""Group keys and deterministic buckets."""

from __future__ import annotations

from tillroll.functions.text import has_line_break_or_tab, trim_blanks
from tillroll.model import MAX_KEY_BYTES, UNKNOWN_GROUP, GroupMode

_BLANK = r"[\x00-\x20]*+"


def trimmed_code(category_code: str) -> str:
    return trim_blanks(f"coalesce({category_code}, '')")


def group_key(category_id: str, code: str, mode: GroupMode) -> str:
    """The key a purchase counts under, or null when the row has no usable key.

    Identifiers stay text (``01`` differs from ``1``). ``code`` is trimmed already; a missing one is
    a group of its own.
    """
    if mode is GroupMode.CATEGORY_ID:
        digits = f"[0-9]{{1,{MAX_KEY_BYTES}}}"
        return (
            rf"CASE WHEN {category_id} RLIKE r'\A{digits}\z' THEN {category_id} "
            rf"WHEN {category_id} RLIKE r'\A{_BLANK}{digits}{_BLANK}\z' THEN {trim_blanks(category_id)} END"
        )
    key = f"substring_index({code}, '.', 1)" if mode is GroupMode.CATEGORY_ROOT else code
    return (
        f"CASE WHEN {code} = '' THEN '{UNKNOWN_GROUP}' "
        f"WHEN NOT {has_line_break_or_tab(code)} AND octet_length({key}) BETWEEN 1 AND {MAX_KEY_BYTES} THEN {key} END"
    )


def _big_endian(value: str) -> str:
    return f"unhex(lpad(hex(CAST({value} AS BIGINT)), 16, '0'))"


def sample_bucket(uri: str, offset: str, seed: int, buckets: int) -> str:
    """Bucket in ``[0, buckets)`` that depends only on where a line lies and on the seed.

    The first four bytes of SHA-256 over uri, a zero byte, seed and offset, read as a signed
    number and reduced with a floor modulus.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    if buckets == 1:
        return "0"
    position = f"concat(CAST({uri} AS BINARY), X'00', {_big_endian(str(seed))}, {_big_endian(offset)})"
    head = f"CAST(conv(left(sha2({position}, 256), 8), 16, 10) AS BIGINT)"
    # Shifting up and back by 32 bits gives the head its sign.
    return f"CAST(pmod(shiftright(shiftleft({head}, 32), 32), {buckets}) AS INT)"
