"""Exact deduplication against a persistent index of digests.

The index is a table of files bucketed and sorted by digest. A batch of new rows is reduced to one row for each digest,
held against the index by a sort-merge anti-join that moves the batch only, and what is new is appended. The index outlives
the session: it is opened again by its path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import discard, parts_of, stored
from tillroll.session import new_shared_path

_ENTRY = "digest BINARY, doc_id BIGINT, row BIGINT"
#: A digest with more than one in this many of all rows is hot, so there are fewer hot digests than this.
_HOT_SHARE = 1000


def as_it_is(text: Column) -> Column:
    return text


def digests(docs: DataFrame, normalise: Callable[[Column], Column] = as_it_is) -> DataFrame:
    """``doc_id, row, digest``: SHA-256 of the normalised text of every row, null being empty, and a number for the row."""
    text = normalise(F.coalesce(F.col("text").cast("string"), F.lit("")))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


class DigestIndex:
    """``digest, doc_id, row`` of the first owner of every digest, in ``buckets`` buckets by digest, sorted within files.

    Files of a bucket are only added, by Spark's committed writes: a batch that fails leaves nothing, and one that is
    added twice changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        """Opens the index at ``path``, which may be new. ``buckets`` must be the number it was made with."""
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.name} ({_ENTRY}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {buckets} BUCKETS LOCATION '{where}'"
        )

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def unknown(self, owners: DataFrame) -> DataFrame:
        """Rows of ``owners`` whose digest is not in the index. The index is read in buckets, only ``owners`` is moved."""
        return owners.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, batch: DataFrame) -> None:
        """Enter the digests of ``batch`` (``doc_id, row, digest``) that are new, each under its greatest ``doc_id``."""
        owner = F.max(F.struct("doc_id", "row")).alias("owner")
        owners = batch.groupBy("digest").agg(owner).select("digest", "owner.doc_id", "owner.row")
        # The index is both read and added to: what is new is settled before the first file is added.
        fresh = stored(self.unknown(owners), "fresh")
        dealt = fresh.repartition(self.buckets, "digest")
        dealt.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)
        discard(fresh)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def membership(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``digests``, by the owners in ``index``.

    Digests with over a thousandth of the rows, fewer than a thousand by that, are broadcast; the others are few rows each
    and meet the index in its buckets.
    """
    total = rows.count()
    sizes = stored(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")), "sizes")
    owners = index.entries().select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    groups = stored(sizes.join(owners.hint("merge"), "digest"), "groups")
    hot = groups.where(F.col("group_size") * _HOT_SHARE > total)
    common = rows.join(F.broadcast(hot), "digest")
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(groups.hint("merge"), "digest")
    kept = F.col("row").eqNullSafe(F.col("keep_row")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return common.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicate(
    docs: DataFrame,
    path: str | None = None,
    normalise: Callable[[Column], Column] = as_it_is,
    rows_per_bucket: int = 1_000_000,
    batches: int = 2,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: of rows with equal texts the one with the greatest ``doc_id`` stays.

    The rows enter a new index at ``path`` (or in the shared folder) in ``batches`` by falling ranges of ``doc_id``, each
    held against what the ones before have entered; so the owner in the index is the greatest id. ``group_size`` counts the
    rows of a text. Null texts are empty texts and alike; texts of any length are read whole. Null ids come last: one stays
    only where all ids of its text are null. Of repeated rows with the same id and text one is kept. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = digests(docs, normalise)
    index = DigestIndex(docs.sparkSession, path or new_shared_path(docs.sparkSession, "digest-index"), parts_of(rows.count(), rows_per_bucket))
    ends = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = (ends["low"], ends["high"]) if ends["low"] is not None else (0, 0)
    place = F.col("doc_id")
    for number in range(batches):
        # The first batch has the greatest ids, the last takes what is left, null ids too.
        top = high - (high - low + 1) * number // batches
        bottom = high - (high - low + 1) * (number + 1) // batches
        inside = (place <= top) & (place > bottom) if number < batches - 1 else F.coalesce(place <= top, F.lit(True))
        index.add(rows.where(inside))
    return membership(rows, index)
