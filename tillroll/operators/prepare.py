"""Every event row to exactly one outcome, with key and amount for the valid purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import model as M
from tillroll.functions.keys import group_key, trimmed_code
from tillroll.functions.money import minor_steps
from tillroll.functions.text import trim_blanks
from tillroll.model import GroupMode
from tillroll.session import select_in_steps

PREPARED_COLUMNS = ("reason", "group_key", "price_minor", "missing_code")


def prepare(events: DataFrame, mode: GroupMode | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Classify events and attach key and amount to the valid purchases.

    ``events`` needs ``event_type, category_id, category_code, price_text`` and, when it comes
    from parsed lines, ``kind``. The result has ``reason, group_key, price_minor, missing_code``
    behind the columns named in ``keep``; ``group_key`` and ``price_minor`` are set together, on
    valid purchases only.
    """
    mode = GroupMode.of(mode)
    kind = "kind" if "kind" in events.columns else f"'{M.KIND_EVENT}'"
    known = ", ".join(f"'{t}'" for t in (M.PURCHASE, *M.OTHER_KNOWN_TYPES))
    is_purchase = f"kind = '{M.KIND_EVENT}' AND event_type = '{M.PURCHASE}'"
    is_valid = f"reason = '{M.VALID_PURCHASE}'"
    counts_missing = "no_code" if mode is not GroupMode.CATEGORY_ID else "false"
    kept = [f"`{c}`" for c in keep]
    # One select per step: the amount and the key are worked out once and used several times.
    return select_in_steps(
        events,
        [
            *kept,
            f"{kind} AS kind",
            f"if(event_type IN ({known}), event_type, {trim_blanks("coalesce(event_type, '')")}) AS event_type",
            "category_id",
            f"{trimmed_code('category_code')} AS code",
            "price_text",
        ],
        [
            *kept,
            "kind",
            "event_type",
            f"if({is_purchase}, {group_key('category_id', 'code', mode)}, NULL) AS key",
            "code = '' AS no_code",
            f"if({is_purchase}, coalesce(price_text, ''), NULL) AS price_text",
        ],
        *minor_steps("price_text", "amount"),
        [*kept, f"{_REASON} AS reason", "amount", "key", "no_code"],
        [
            *kept,
            "reason",
            f"if({is_valid}, key, NULL) AS group_key",
            f"if({is_valid}, amount, NULL) AS price_minor",
            f"{is_valid} AND {counts_missing} AS missing_code",
        ],
    )


# The first rule that applies decides; price is judged before group.
_REASON = f"""CASE
    WHEN kind = '{M.KIND_HEADER}' THEN '{M.HEADER}'
    WHEN kind = '{M.KIND_MALFORMED}' THEN '{M.MALFORMED_CSV}'
    WHEN event_type IN ({", ".join(f"'{t}'" for t in M.OTHER_KNOWN_TYPES)}) THEN '{M.NON_PURCHASE}'
    WHEN event_type <> '{M.PURCHASE}' THEN '{M.UNKNOWN_EVENT}'
    WHEN amount IS NULL THEN '{M.INVALID_PRICE}'
    WHEN key IS NULL THEN '{M.INVALID_GROUP}'
    ELSE '{M.VALID_PURCHASE}' END"""


def purchases_only(events: DataFrame) -> DataFrame:
    """Drop rows that cannot be purchases before anything is parsed.

    The test is weaker than the exact one, which runs later, but a Parquet scan can apply it.
    """
    return events.where(F.col("event_type").contains(M.PURCHASE))
