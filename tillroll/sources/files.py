"""Finding event files and reading their lines, with byte offsets where they matter."""

from __future__ import annotations

import re
import unicodedata
import urllib.parse
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.sources import byteranges


class InputError(ValueError):
    """The named inputs cannot be used."""


@dataclass(frozen=True)
class InputFile:
    uri: str  # fully qualified and escaped, as _metadata.file_path reports it
    bytes: int
    spark_path: str  # what a reader takes: not escaped, glob characters masked


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, both as driver-side Hadoop objects."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def _named(uri: str, size: int) -> InputFile:
    return InputFile(uri, size, re.sub(r"([\[\]{}*?\\])", r"\\\1", urllib.parse.unquote(uri)))


def _uri(spark: SparkSession, qualified) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(qualified.toString()).toUri().toString()


def _input_file(spark: SparkSession, fs, status) -> InputFile:
    return _named(_uri(spark, fs.makeQualified(status.getPath())), status.getLen())


def escaped(name: str) -> str:
    """A file name as it stands in a URI: as Java escapes it, letters of all scripts stay."""

    def escape(found: re.Match) -> str:
        char = found.group()
        plain = ord(char) > 127 and unicodedata.category(char) not in ("Zs", "Zl", "Zp", "Cc")
        return char if plain else urllib.parse.quote(char)

    return re.sub(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@]", escape, name)


def list_csv(spark: SparkSession, location: str) -> list[InputFile]:
    """A file, or the ``*.csv`` files directly inside a directory, in path order.

    A directory is listed in one call, where its store can be opened from Python as well.
    """
    jpath, fs = hadoop_path(spark, location)
    if not fs.exists(jpath):
        raise InputError(f"No such input: {location}")
    status = fs.getFileStatus(jpath)
    parent = _uri(spark, fs.makeQualified(jpath)).rstrip("/")
    if status.isFile():
        found = [_input_file(spark, fs, status)]
    elif byteranges.can_open(parent):
        store, path = pafs.FileSystem.from_uri(byteranges.address_of(parent))
        listed = (i for i in store.get_file_info(pafs.FileSelector(path)) if i.is_file and i.base_name.endswith(".csv"))
        found = [_named(f"{parent}/{escaped(i.base_name)}", i.size) for i in listed]
    else:
        children = (s for s in fs.listStatus(jpath) if s.isFile())
        found = [_input_file(spark, fs, s) for s in children if s.getPath().getName().endswith(".csv")]
    if not found:
        raise InputError(f"{location} has no file that ends in .csv")
    return check_inputs(sorted(found, key=lambda f: f.spark_path))


def _sizes() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sizes of named files, null for what is no file; nested so that it travels to executors by value."""
    address_of = byteranges.address_of

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris = batch.column("uri").to_pylist()
            stores: dict[str, tuple[pafs.FileSystem, list[int], list[str]]] = {}
            for at, uri in enumerate(uris):
                # The store of a scheme and host is opened once; what is left of the address is the path in it.
                parts = urllib.parse.urlsplit(address_of(uri))
                if (key := f"{parts.scheme}://{parts.netloc}") not in stores:
                    stores[key] = pafs.FileSystem.from_uri(f"{key}/")[0], [], []
                own = parts.path if parts.scheme in ("file", "hdfs") else parts.netloc + parts.path
                stores[key][1].append(at)
                stores[key][2].append(urllib.parse.unquote(own))
            sizes: list[int | None] = [None] * len(uris)
            for store, places, paths in stores.values():
                for at, info in zip(places, store.get_file_info(paths), strict=True):
                    sizes[at] = info.size if info.is_file else None
            yield pa.RecordBatch.from_arrays([batch.column("uri"), pa.array(sizes, pa.int64())], names=["uri", "bytes"])

    return look_up


def files_at(spark: SparkSession, names: Sequence[str] | DataFrame) -> list[InputFile]:
    """Exactly the named files (URIs, or a table with ``uri``), as a manifest lists them, in the order of their names.

    Tasks look the names up, many at a time. Stores that only Spark can open are asked file by file.
    """
    if not isinstance(names, DataFrame):
        if not names:
            return check_inputs([])
        names = spark.createDataFrame([(u,) for u in names], "uri string")
    names = names.select("uri")
    schemes = {r[0] for r in names.select(F.substring_index("uri", ":", 1)).distinct().limit(100).collect()}
    if all(byteranges.can_open(f"{s}:") for s in schemes):
        found = names.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_sizes(), "uri string, bytes bigint")
        listed = found.orderBy("uri").toArrow().to_pydict()
        files = [(u, n) for u, n in zip(listed["uri"], listed["bytes"], strict=True)]
        if missing := [u for u, n in files if n is None]:
            raise InputError(f"No such input: {missing[0]}")
        return check_inputs([_named(u, n) for u, n in files])
    files = []
    for row in names.orderBy("uri").toLocalIterator():
        jpath = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["uri"]))
        fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(jpath):
            raise InputError(f"No such input: {row['uri']}")
        files.append(_input_file(spark, fs, fs.getFileStatus(jpath)))
    return check_inputs(files)


def check_inputs(files: Sequence[InputFile]) -> list[InputFile]:
    if not files:
        raise InputError("There is nothing to read")
    if len({f.uri for f in files}) < len(files):
        raise InputError("A file is named twice")
    if not all(f.uri.endswith(".csv") for f in files):
        raise InputError("Event files end in .csv and are not compressed")
    return list(files)


def scan_splits(spark: SparkSession, files: Sequence[InputFile]) -> DataFrame:
    """Every line of the files with the split it came from; no shuffle, no offsets.

    Only LF ends a line here. Spark's default would also split at a lone CR, which the contract
    treats as damage to be reported.
    """
    return (
        spark.read.option("lineSep", "\n")
        .text([f.spark_path for f in files])
        .select(
            "value",
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("split_start"),
        )
    )


def _position_counter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Running byte position of each line within its split; a task reads splits one after another.

    The worker function is nested so that it travels by value: executors need not have this package.
    """

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            uri, start = batch.column("uri"), batch.column("split_start")
            size = pc.binary_length(batch.column("value")).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            before = np.cumsum(size) - size
            changed = pc.or_(pc.not_equal(uri[1:], uri[:-1]), pc.not_equal(start[1:], start[:-1]))
            first = np.concatenate([[0], np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1])
            origin = before[first]
            if (uri[0].as_py(), start[0].as_py()) == current:
                origin[0] = -position
            within = before - np.repeat(origin, np.diff(np.append(first, batch.num_rows)))
            current, position = (uri[-1].as_py(), start[-1].as_py()), int(within[-1] + size[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("value"), uri, start, pa.array(within)],
                names=["value", "uri", "split_start", "within"],
            )

    return positions


def _split_bytes(spark: SparkSession, files: Sequence[InputFile]) -> int:
    """A lower bound of the split size Spark picks for these files."""
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    largest = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting))
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    open_cost = int(size(spark.conf.get("spark.sql.files.openCostInBytes").lower()))
    wanted = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    per_task = sum(f.bytes + open_cost for f in files) // max(1, int(wanted))
    return max(1, min(largest, max(per_task, open_cost)))


def scan_lines(spark: SparkSession, files: Sequence[InputFile]) -> DataFrame:
    """``uri, offset, value``: every line with its exact byte offset, each byte read once.

    Tasks open byte ranges themselves, see :mod:`tillroll.sources.byteranges`. Stores that only Spark's readers can open
    are read twice, by :func:`scan_lines_by_splits`.
    """
    if not all(byteranges.can_open(f.uri) for f in files):
        return scan_lines_by_splits(spark, files)
    lines = byteranges.scan(spark, [(f.uri, f.bytes) for f in files], _split_bytes(spark, files))
    return lines.withColumn("value", F.col("value").cast("string"))


def scan_lines_by_splits(spark: SparkSession, files: Sequence[InputFile]) -> DataFrame:
    """:func:`scan_lines` from Spark's text reader, which does not tell where its splits' first lines begin.

    A line's offset is the bytes in earlier splits of its file plus the bytes before it in its own
    split. The first part is one small aggregate (a row per split); the second runs inside the
    scanning task. Files are told apart by a 64-bit hash in the join.
    """
    lines = scan_splits(spark, files)
    per_split = lines.groupBy("uri", "split_start").agg(
        F.sum(F.octet_length("value") + 1).alias("split_bytes"),
        F.max("file_size").alias("file_size"),
    )
    whole = Window.partitionBy("uri")
    earlier = whole.orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    # The reader swallows a byte order mark at the start of a file; the file size gives it away.
    bases = per_split.select(
        F.xxhash64("uri").alias("file"),
        "split_start",
        F.coalesce(F.sum("split_bytes").over(earlier), F.lit(0)).alias("base"),
        F.when(F.col("file_size") - F.sum("split_bytes").over(whole) >= 2, 3).otherwise(0).alias("mark"),
    )
    placed = lines.select(F.col("value").cast("binary"), "uri", "split_start").mapInArrow(
        _position_counter(), "value binary, uri string, split_start bigint, within bigint"
    )
    position = F.col("base") + F.col("within")
    return placed.withColumn("file", F.xxhash64("uri")).join(bases, ["file", "split_start"]).select(
        "uri",
        F.when(position > 0, position + F.col("mark")).otherwise(position).alias("offset"),
        F.col("value").cast("string").alias("value"),
    )
