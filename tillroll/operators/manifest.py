"""What exactly was read: digests per file or slice, one fingerprint over all, and drift between two."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import utf16_order
from tillroll.model import POLICY_HASH, SCHEMA_VERSION
from tillroll.operators import digests
from tillroll.session import fail_if
from tillroll.sources import byteranges
from tillroll.sources.files import InputFile

# Files up to this size are hashed as one value; larger ones are streamed.
_WHOLE_FILE_BYTES = 64 * 1024 * 1024


def _file_hasher() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """SHA-256 of whole files in fixed memory; nested so that it travels to executors by value."""

    address_of = byteranges.address_of

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uri in batch["uri"]:
                store, path = pafs.FileSystem.from_uri(address_of(uri))
                digest, size = hashlib.sha256(), 0
                with store.open_input_stream(path) as stream:
                    while chunk := stream.read(8 << 20):
                        digest.update(chunk)
                        size += len(chunk)
                rows.append((uri, size, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["uri", "bytes", "sha256"])

    return hashes


def file_manifest(spark: SparkSession, files: Sequence[InputFile]) -> DataFrame:
    """``uri, bytes, sha256`` of each file's bytes.

    SHA-256 of a file is sequential by definition, so the unit of work is a file: small ones many to
    a task inside the JVM, large ones streamed one to a task. For a few files too large for that,
    :func:`line_manifest` digests lines instead and splits any file.
    """
    schema = "uri string, bytes bigint, sha256 string"
    small = [f.spark_path for f in files if f.bytes <= _WHOLE_FILE_BYTES]
    large = [(f.uri,) for f in files if f.bytes > _WHOLE_FILE_BYTES]
    parts = []
    if small:
        content = spark.read.format("binaryFile").load(small)
        parts.append(
            content.select(
                F.col("_metadata.file_path").alias("uri"),
                F.col("length").alias("bytes"),
                F.sha2("content", 256).alias("sha256"),
            )
        )
    if large:
        names = spark.createDataFrame(large, "uri string").repartition(len(large), "uri")
        parts.append(names.mapInPandas(_file_hasher(), schema))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def file_stamps(spark: SparkSession, files: Sequence[InputFile]) -> DataFrame:
    """``uri, bytes, modified`` of each file as the store lists it; nothing is read."""
    listed = spark.read.format("binaryFile").load([f.spark_path for f in files])
    return listed.select(
        F.col("_metadata.file_path").alias("uri"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )


def line_manifest(lines: DataFrame) -> DataFrame:
    """``uri, bytes, sha256`` per file or slice from ``uri, offset, value``, see :func:`digests.line_digest`."""
    return digests.line_digest(lines)


def row_text(*columns: str) -> str:
    """SQL for all of a row's ``columns`` as one text: the length of each, and nulls, are written out.

    Different rows have different texts, whatever the columns hold.
    """
    cells = (f"coalesce(concat(char_length(CAST(`{c}` AS STRING)), ':', CAST(`{c}` AS STRING)), '-')" for c in columns)
    return f"concat_ws(';', {', '.join(cells)})"


def manifest_fingerprint(manifest: DataFrame) -> DataFrame:
    """One row with ``input_fingerprint``: SHA-256 over the policy and all entries sorted by uri.

    The published formula is one digest over one text, so the entries (names and digests of files,
    not data) meet in one row. An entry that is repeated or damaged fails the job.
    """
    entries = manifest.select("uri", "bytes", "sha256")
    sound = F.col("uri").isNotNull() & (F.col("bytes") >= 0) & F.col("sha256").rlike(r"\A[0-9a-f]{64}\z")
    line = F.concat_ws("\t", "uri", F.col("bytes").cast("string"), "sha256")
    entry = F.struct(F.expr(utf16_order("uri")).alias("order"), F.concat(line, F.lit("\n")).alias("line"))
    gathered = entries.agg(
        F.array_sort(F.collect_list(entry)).alias("entries"),
        F.count(F.lit(1)).alias("files"),
        F.count_distinct("uri").alias("uris"),
        F.count_if(F.coalesce(~sound, F.lit(True))).alias("damaged"),
    )
    bad = (F.col("files") == 0) | (F.col("uris") != F.col("files")) | (F.col("damaged") > 0)
    canonical = F.concat(F.lit(POLICY_HASH + "\n"), F.array_join("entries.line", ""))
    return gathered.select(
        fail_if(bad, "Invalid or duplicate manifest entry", F.sha2(canonical.cast("binary"), 256)).alias(
            "input_fingerprint"
        ),
        F.lit(POLICY_HASH).alias("policy_hash"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "files",
    )


def input_drift(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """``uri, change`` for entries that differ between a manifest and the present state."""
    before = manifest.select("uri", F.col("bytes").alias("b0"), F.col("sha256").alias("s0"))
    after = current.select("uri", F.col("bytes").alias("b1"), F.col("sha256").alias("s1"))
    change = (
        F.when(F.col("s1").isNull(), "missing")
        .when(F.col("s0").isNull(), "added")
        .when(~F.col("b0").eqNullSafe(F.col("b1")), "bytes")
        .when(~F.col("s0").eqNullSafe(F.col("s1")), "content")
    )
    return before.join(after, "uri", "full_outer").select("uri", change.alias("change")).where(F.col("change").isNotNull())


def provenance_match(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
    """``field, left_value, right_value, equal`` for the provenance columns of two one-row frames."""
    pairs = F.array(
        *(
            F.struct(
                F.lit(c).alias("field"),
                F.col(c).cast("string").alias("left_value"),
                _only_value(right, c).cast("string").alias("right_value"),
            )
            for c in columns
        )
    )
    listed = left.select(F.inline(pairs))
    return listed.withColumn("equal", F.col("left_value").eqNullSafe(F.col("right_value")))


def _only_value(one_row: DataFrame, column: str) -> Column:
    return one_row.select(column).scalar()
