"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within the allowed distance have one segment that differs
in a bit at most. Each segment is indexed once for every bit it could differ in, with that bit blanked; equal blanked
segments meet in an equality join, and the whole distance is verified there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import components, stored

_SEED = 42
#: Shingles whose bits are counted at once.
_BLOCK = 1 << 16
#: A bucket of more fingerprints than this is split by further blanked bits instead of being compared pair by pair.
_BUCKET = 2048


def simhash(text: str | None, words: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a text; 0 when it has no word."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    count = max(1, len(tokens) - words + 1)
    starts = np.concatenate(([0], ends[: count - 1]))
    stops = ends[min(words, len(tokens)) - 1 :][:count] - 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), stops[at : at + _BLOCK].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], _SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, digest, fp`` of every row; a null text counts as empty. ``fp`` holds the 64 bits as a signed long, and
    the digest of the text tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(t.as_py(), words) for t in batch.column(2)], "<u8").view("<i8")
            columns = [batch.column(0), batch.column(1), pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, digest long, fp long")


def _digest() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _variants(max_bits: int) -> Column:
    """A key for every one-blank variant of every segment of ``fp``: the segment's other bits and the number of the blank."""
    segments = max_bits // 2 + 1
    bounds = [64 * s // segments for s in range(segments + 1)]
    keys = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        for bit in range(low, high):
            others = sum(1 << b for b in range(low, high) if b != bit)
            segment = F.shiftrightunsigned(F.col("fp").bitwiseAND(F.lit(_signed(others))), low)
            keys.append(segment.bitwiseOR(F.lit(_signed(bit << 58))))
    return F.explode(F.array(*keys))


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """``u, v``: fingerprints of the column ``fp`` that hang together at ``max_bits`` or fewer differing bits.

    Pairs of one bucket are compared in the join. A bucket of more than ``_BUCKET`` fingerprints is not: its members
    get all variants with ``max_bits`` blanks. Those that agree in such a variant differ in these bits only, so all of
    them are linked, by a star to the smallest, and the links stay linear in the members.
    """
    if not 2 <= max_bits <= 4:
        raise ValueError("max_bits must be 2 to 4")
    distinct = prints.select("fp").where("fp is not null").distinct()
    rows = distinct.select("fp", _variants(max_bits).alias("key"))
    rows = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    left = rows.where(F.col("n") <= _BUCKET).select("key", F.col("fp").alias("u"))
    right = rows.where(F.col("n") <= _BUCKET).select("key", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    pairs = left.join(right, "key").where((F.col("u") < F.col("v")) & near).select("u", "v")
    crowded = rows.where(F.col("n") > _BUCKET).select("fp").distinct().selectExpr("fp", "fp AS rest", "-1 AS b0")
    for i in range(1, max_bits + 1):
        crowded = crowded.selectExpr("*", f"explode(sequence(b{i - 1} + 1, {63 - max_bits + i})) AS b{i}")
        crowded = crowded.withColumn("rest", F.expr(f"rest & ~shiftleft(1L, b{i})"))
    stars = (
        crowded.groupBy("rest", *(f"b{i}" for i in range(1, max_bits + 1)))
        .agg(F.min("fp").alias("u"), F.collect_set("fp").alias("all"))
        .select("u", F.explode("all").alias("v"))
        .where("u <> v")
    )
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the smallest ``doc_id`` that can be
    reached over links, the own one included. Null and empty texts and texts without a word have fingerprint zero and
    link like any other. Repeated rows stay rows; rows with one ``doc_id`` and different texts are judged by their own
    texts. A null ``doc_id`` stays null and names no component unless all in it are null. Other columns are ignored; an
    empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = _components(prints, distinct, max_bits)
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "component").select("fp", "component_id")
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fp").select("doc_id", fingerprint, "component_id")


def _components(prints: DataFrame, distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` (a row for each ``fp``) with the smallest fingerprint of its component."""
    labels = components(links(prints, max_bits)).select(F.col("node").alias("fp"), "component")
    return distinct.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component of ``near_duplicates`` the document of smallest
    ``doc_id`` stays (one without an id only if none has one; of several texts under one id that of smallest digest). Of
    repeated rows one stays."""
    prints = stored(fingerprints(docs, words), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")
    named = _components(prints, prints.groupBy("fp").agg(F.min(order).alias("first")), max_bits)
    firsts = named.groupBy("component").agg(F.min("first").alias("first"))
    kept = firsts.select(F.struct("first.doc_id", "first.digest").alias("kept"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), _digest().alias("digest"), F.struct("*").alias("row"))
    rows = rows.join(kept, F.expr("id <=> kept.doc_id AND digest = kept.digest"), "left_semi")
    rows = rows.groupBy("id", "digest").agg(F.min("row").alias("row"))
    return rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
