"""Group dictionaries: sorted distinct keys with dense ids, their checksum, and lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.functions.text import has_line_break_or_tab, utf16_length, utf16_order
from tillroll.model import MAX_KEY_BYTES, POLICY_HASH, SCHEMA_VERSION, GroupMode
from tillroll.operators import digests
from tillroll.operators.digests import Shape
from tillroll.session import fail_if, materialize, row_count

def counted_groups(prepared: DataFrame) -> DataFrame:
    """Valid purchases per key. The blank group of all other rows counts zero and falls away."""
    counted = prepared.groupBy(F.expr("coalesce(group_key, '') AS group_key")).agg(F.count("price_minor").alias("purchase_count"))
    return counted.where(F.col("purchase_count") > 0)


class TooManyGroups(ValueError):
    """There are more groups than the caller allows."""


def guarded(groups: DataFrame, max_keys: int | None) -> DataFrame:
    """``groups`` stored, or :class:`TooManyGroups` if it has more than ``max_keys`` rows; it is worked out once."""
    if max_keys is None:
        return groups
    if max_keys < 1:
        raise ValueError("max_keys must be positive")
    groups = materialize(groups)
    if (count := groups.count()) > max_keys:
        raise TooManyGroups(f"More than {max_keys} groups: {count}")
    return groups


def guard_rows(rows: DataFrame, max_keys: int | None, key: str = "group_key") -> DataFrame:
    """``rows`` as they are; a task that meets more than ``max_keys`` keys fails the job, before anything is shuffled.

    A task keeps that many 64-bit hashes of keys at most. Keys that are too many only together are left to
    :func:`guarded`, which counts them exactly after the grouping.
    """
    if max_keys is None:
        return rows
    if max_keys < 1:
        raise ValueError("max_keys must be positive")
    hashed = rows.withColumn("_key", F.when(F.col(key).isNotNull(), F.xxhash64(key)))
    schema = StructType([f for f in hashed.schema.fields if f.name != "_key"])
    return hashed.mapInArrow(_key_counter(max_keys), schema)


def _key_counter(max_keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nested so that it travels to executors by value."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            at = batch.schema.get_field_index("_key")
            seen.update(pc.unique(batch.column(at)).drop_null().to_pylist())
            if len(seen) > max_keys:
                raise ValueError(f"More than {max_keys} groups")
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.columns) if i != at], names=[n for n in batch.schema.names if n != "_key"]
            )

    return check


def build_dictionary(groups: DataFrame, max_keys: int | None = None) -> DataFrame:
    """``id, group_key`` with ids 0..K-1 in key order, from a frame of distinct keys.

    Keys are dealt by range and stored once; an id is the place in the range behind the keys of the
    ranges before it. Only the number of ranges is known to one task. ``max_keys`` is a guard for
    callers that want one.
    """
    keys = guarded(groups.select("group_key"), max_keys)
    ranged = keys.repartitionByRange(F.expr(utf16_order("group_key"))).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.expr(utf16_order("group_key"))))
    placed = ranged.withColumn("place", place).join(firsts, "part")
    return placed.select((F.col("first") + F.col("place") - 1).alias("id"), "group_key")


def encode(states: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Put ids in the place of keys; a key that is not listed fails the job, it is never dropped.

    States are joined, a row per key (and slice), not the purchases that went into them.
    """
    joined = states.join(dictionary.select("id", "group_key"), "group_key", "left")
    message = F.concat(F.lit("Not in the dictionary: "), F.col("group_key"))
    others = [c for c in states.columns if c != "group_key"]
    return joined.select(fail_if(F.col("id").isNull(), message, F.col("id")).alias("id"), *others)


def decode(states: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Put keys in the place of ids; an id that is not listed fails the job."""
    joined = states.join(dictionary.select("id", "group_key"), "id", "left")
    message = F.concat(F.lit("Not an id of the dictionary: "), F.col("id").cast("string"))
    others = [c for c in states.columns if c != "id"]
    return joined.select(fail_if(F.col("group_key").isNull(), message, F.col("group_key")).alias("group_key"), *others)


def dictionary_misses(prepared: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Purchases per key that the dictionary lacks; rows are counted before they are looked up."""
    return counted_groups(prepared).join(dictionary.select("group_key"), "group_key", "left_anti")


def dictionary_checksum(dictionary: DataFrame, fingerprint: Column, mode: GroupMode | str) -> DataFrame:
    """SHA-256 over provenance and every key with its UTF-16 length, in id order.

    The published format is one digest over one text, and one JSON object with all keys, so the text
    is one row: a stored dictionary suits thousands of groups, and callers that publish it name a
    ``max_keys``. Ids and lookups need neither.
    """
    key = F.col("group_key")
    line = F.concat(F.lit("\n"), F.expr(utf16_length("group_key")).cast("string"), F.lit(":"), key)
    lines = dictionary.select("id", "group_key").agg(
        F.array_sort(F.collect_list(F.struct("id", line.alias("line")))).alias("lines"),
        F.count(F.lit(1)).cast("int").alias("groups"),
    )
    head = F.concat_ws("|", F.lit(str(SCHEMA_VERSION)), "input_fingerprint", "group_mode", "policy_hash")
    provenance = lines.select(
        fingerprint.alias("input_fingerprint"),
        F.lit(GroupMode.of(mode).value).alias("group_mode"),
        F.lit(POLICY_HASH).alias("policy_hash"),
        "groups",
        F.array_join("lines.line", "").alias("body"),
    )
    return provenance.withColumn("checksum", F.sha2(F.concat(head, "body"), 256)).drop("body")


#: Ids to a block of the digest, 1024 blocks to a node above.
RANGES = Shape(block_bytes=4096)


def _as_lines(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(F.lit("dictionary").alias("uri"), F.col("id").cast("bigint").alias("offset"), F.col("group_key").alias("value"))


def dictionary_digest(dictionary: DataFrame, fingerprint: Column, mode: GroupMode | str) -> DataFrame:
    """Provenance and a digest over all ids and keys, of a dictionary of any size.

    Tasks add up hashes of entries by ranges of ids (:mod:`digests`); no row, task or text holds the keys. An empty
    dictionary has a digest too.
    """
    root = digests.line_digest(_as_lines(dictionary)).agg(F.coalesce(F.max("sha256"), F.lit("")).alias("root"))
    head = ("input_fingerprint", "group_mode", "policy_hash", "groups", "root")
    rows = root.select(
        fingerprint.alias("input_fingerprint"),
        F.lit(GroupMode.of(mode).value).alias("group_mode"),
        F.lit(POLICY_HASH).alias("policy_hash"),
        row_count(dictionary).alias("groups"),
        "root",
    )
    text = F.concat_ws("|", *(F.col(c).cast("string") for c in head))
    return rows.select(*head[:-1], F.sha2(text.cast("binary"), 256).alias("digest"))


def dictionary_tree(dictionary: DataFrame, shape: Shape = RANGES) -> DataFrame:
    """Digests of ranges of ids under one root; two trees tell by :func:`digests.tree_drift` in which ranges they differ."""
    return digests.tree(_as_lines(dictionary), shape)


def dictionary_violations(dictionary: DataFrame, max_keys: int | None = None) -> DataFrame:
    """``id, group_key, rule`` for every entry that breaks a rule.

    Neighbours meet in an equi-join on the position, so a damaged dictionary of any size is checked
    without sorting it in one place.
    """
    entries = dictionary.select("id", "group_key")
    previous = entries.select((F.col("id") + 1).alias("id"), F.col("group_key").alias("previous"))
    paired = entries.join(previous, "id", "left")
    key, size = F.col("group_key"), F.octet_length("group_key")
    rules = {
        "empty_key": key.isNull() | (key == ""),
        "key_too_long": size > MAX_KEY_BYTES,
        "unsafe_character": F.expr(has_line_break_or_tab("group_key")),
        "not_ascending": F.expr(f"{utf16_order('previous')} >= {utf16_order('group_key')}"),
    }
    if max_keys is not None:
        rules["beyond_guard"] = F.col("id") >= max_keys
    broken = F.array(*(F.when(test, F.lit(name)) for name, test in rules.items()))
    return paired.select("id", "group_key", F.explode(F.array_compact(broken)).alias("rule"))
