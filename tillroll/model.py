"""Schemas, limits and names shared by every operator."""

from __future__ import annotations

import enum
import hashlib

from pyspark.sql import types as T

# The event file contract, its limits, and the names of row kinds, outcomes and columns.
EVENT_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)
HEADER_LINE = ",".join(EVENT_COLUMNS)
PURCHASE = "purchase"
OTHER_KNOWN_TYPES = ("view", "cart", "remove_from_cart")
UNKNOWN_GROUP = "__UNKNOWN__"
POLICY = "revenue-v1:purchase:scale2:halfup:unknown-code:category-id-string:no-dedup:key256:line65536"
POLICY_HASH = hashlib.sha256(POLICY.encode()).hexdigest()
SCHEMA_VERSION = 1
MAX_LINE_BYTES = 65_536
MAX_KEY_BYTES = 256
MAX_REPORTED_ERRORS = 20
SAMPLE_BUCKETS = 1_000_000
DEFAULT_SEED = 21

# Row kinds after parsing a line.
KIND_HEADER = "HEADER"
KIND_EVENT = "EVENT"
KIND_MALFORMED = "MALFORMED"

# Row outcomes, in the order in which they are decided.
HEADER = "HEADER"
MALFORMED_CSV = "MALFORMED_CSV"
NON_PURCHASE = "NON_PURCHASE"
UNKNOWN_EVENT = "UNKNOWN_EVENT"
INVALID_PRICE = "INVALID_PRICE"
INVALID_GROUP = "INVALID_GROUP"
VALID_PURCHASE = "VALID_PURCHASE"
REASONS = (
    HEADER,
    MALFORMED_CSV,
    NON_PURCHASE,
    UNKNOWN_EVENT,
    INVALID_PRICE,
    INVALID_GROUP,
    VALID_PURCHASE,
)
EXPORT_COLUMNS = ("group_key", "total_revenue", "purchase_count", "average_revenue")

RAW_EVENT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])


class GroupMode(str, enum.Enum):
    """What a purchase is grouped by."""

    CATEGORY_ID = "CATEGORY_ID"
    CATEGORY_CODE = "CATEGORY_CODE"
    CATEGORY_ROOT = "CATEGORY_ROOT"

    @classmethod
    def of(cls, name: str | GroupMode) -> GroupMode:
        return name if isinstance(name, cls) else cls(name.upper())
