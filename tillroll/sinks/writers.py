"""Create-only outputs: result tables, CSV exports, samples and JSON artifacts.

Every output is written to a staging folder next to its target and renamed at the end, so a failed
or interrupted run never leaves a half-written target.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import csv_key_field, utf16_order
from tillroll.model import EXPORT_COLUMNS, HEADER_LINE
from tillroll.operators.aggregate import result_rows
from tillroll.sources import byteranges
from tillroll.sources.files import escaped, hadoop_path


class OutputError(ValueError):
    """The target exists already or touches an input."""


def ensure_new(spark: SparkSession, path: str) -> None:
    jpath, fs = hadoop_path(spark, path)
    if fs.exists(jpath):
        raise OutputError(f"{path} is there already")


def ensure_apart(spark: SparkSession, output: str, *inputs: str) -> None:
    """Neither path may lie inside the other."""

    def qualified(path: str) -> str:
        jpath, fs = hadoop_path(spark, path)
        return fs.makeQualified(jpath).toUri().toString().replace("file:///", "file:/").rstrip("/") + "/"

    target = qualified(output)
    for path in inputs:
        other = qualified(path)
        if target.startswith(other) or other.startswith(target):
            raise OutputError(f"The output lies in {path}, or that in the output")


def staging_path(path: str) -> str:
    return f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}"


def claim_path(target: str) -> str:
    return f"{target.rstrip('/')}.claim"


def _claim(spark: SparkSession, target: str) -> str | None:
    """Make the claim file of ``target``; None if another writer holds it.

    The store makes the file only if it is not there, in one step: HDFS and object stores by a create that does not
    overwrite, the local file system by its own call, as Hadoop's looks first and writes afterwards there.
    """
    path = claim_path(target)
    jpath, fs = hadoop_path(spark, path)
    try:
        if fs.makeQualified(jpath).toUri().getScheme() == "file":
            fs.mkdirs(jpath.getParent())
            plain = spark._jvm.java.nio.file.Path.of(fs.makeQualified(jpath).toUri().getPath(), _no_strings(spark))
            spark._jvm.java.nio.file.Files.createFile(plain, _no_attributes(spark))
        else:
            fs.create(jpath, False).close()
    except Py4JJavaError as error:
        kind = error.java_exception.getClass().getSimpleName()
        if kind in ("FileAlreadyExistsException", "AlreadyBeingCreatedException") or fs.exists(jpath):
            return None
        raise
    return path


def _no_strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)


def _no_attributes(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.nio.file.attribute.FileAttribute, 0)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a finished staging path to its target, which must still be free.

    A rename alone would not do: two writers can both find the target free, and on some stores the second rename moves
    its folder below the first. So a writer first claims the target, and only who holds the claim looks and renames. A
    writer that dies in between leaves a claim that keeps others out until :func:`release_claim`.
    """
    claim = _claim(spark, target)
    if claim is None:
        raise OutputError(f"{target} is being published by another writer ({claim_path(target)})")
    try:
        source, fs = hadoop_path(spark, staged)
        destination, _ = hadoop_path(spark, target)
        if fs.exists(destination) or not fs.rename(source, destination):
            raise OutputError(f"{target} cannot take the finished output")
    finally:
        discard(spark, claim)


def release_claim(spark: SparkSession, target: str) -> None:
    """Take away the claim that a dead writer left on ``target``."""
    discard(spark, claim_path(target))


def discard(spark: SparkSession, staged: str) -> None:
    jpath, fs = hadoop_path(spark, staged)
    if fs.exists(jpath):
        fs.delete(jpath, True)


def result_lines(states: DataFrame) -> DataFrame:
    """``value``: one header-less TSV line per group."""
    rows = result_rows(states)
    count = F.col("purchase_count").cast("string")
    return rows.select(F.concat_ws("\t", "group_key", "total_revenue", count, "average_revenue").alias("value"))


def stage_result(states: DataFrame, path: str) -> None:
    """Write result lines as text; the CSV writer would quote or trim unusual keys."""
    result_lines(states).write.mode("errorifexists").text(path)


def write_result(states: DataFrame, path: str) -> None:
    spark = states.sparkSession
    ensure_new(spark, path)
    staged = staging_path(path)
    try:
        stage_result(states, staged)
        publish(spark, staged, path)
    finally:
        discard(spark, staged)


def export_lines(rows: DataFrame) -> DataFrame:
    """``position, value``: the CSV records of a result; in the order of ``position`` the header is first."""
    body = rows.select(
        F.expr(utf16_order("group_key")).alias("position"),
        F.concat_ws(
            ",",
            F.expr(csv_key_field("group_key")),
            "total_revenue",
            F.col("purchase_count").cast("string"),
            "average_revenue",
        ).alias("value"),
    )
    # An empty sort key precedes every group key, which is never empty.
    header = rows.sparkSession.range(1).select(
        F.lit(b"").alias("position"), F.lit(",".join(EXPORT_COLUMNS)).alias("value")
    )
    return header.unionByName(body)


def export_csv(rows: DataFrame, path: str, single: bool = False) -> None:
    """RFC 4180 records with CRLF line ends, sorted over the part files of a folder; the first has the header.

    ``single`` asks for one file instead: the part files are written all the same and then put together, in key order.
    """
    spark = rows.sparkSession
    ensure_new(spark, path)
    staged = staging_path(path)
    try:
        ordered = export_lines(rows).orderBy("position")
        ordered.select("value").write.mode("errorifexists").text(staged, lineSep="\r\n")
        if single:
            whole = f"{staged.rstrip('/')}.whole"
            try:
                join_parts(spark, staged, whole)
                publish(spark, whole, path)
            finally:
                discard(spark, whole)
        else:
            publish(spark, staged, path)
    finally:
        discard(spark, staged)


def join_parts(spark: SparkSession, directory: str, target: str) -> None:
    """The bytes of a folder's part files as one new file, none of them through one task.

    HDFS strings the blocks of the parts together by itself. On a file system that all tasks share, each part has its
    known place in the new file, and tasks copy parts there side by side; a task that runs again writes the same bytes to
    the same place. Object stores can do neither: there the parts stay a folder.
    """
    parts = _sized_parts(spark, directory)
    jpath, fs = hadoop_path(spark, target)
    scheme = fs.makeQualified(jpath).toUri().getScheme()
    if scheme == "hdfs":
        fs.create(jpath, False).close()
        filled = [path for path, size in parts if size]
        if filled:
            sources = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(filled))
            for i, path in enumerate(filled):
                sources[i] = hadoop_path(spark, path)[0]
            fs.concat(jpath, sources)
    elif scheme == "file":
        plain = fs.makeQualified(jpath).toUri().getPath()
        with open(plain, "xb") as made:
            made.truncate(sum(size for _, size in parts))
        places, place = [], 0
        for path, size in parts:
            if size:
                places.append((hadoop_path(spark, path)[0].toUri().getPath(), place, size))
            place += size
        if places:
            frame = spark.createDataFrame(places, "path string, place bigint, size bigint")
            spread = frame.repartition(len(places), "place")
            copied = spread.mapInArrow(_copier(plain), "copied bigint").agg(F.sum("copied").alias("n")).first()["n"]
            if copied != place:
                raise OutputError(f"Only {copied} of {place} bytes reached {target}")
    else:
        raise OutputError(f"A store of scheme {scheme} cannot put part files together; export a folder instead")


def _copier(target: str, chunk_bytes: int = 8 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Copies each part to its place in ``target``; nested so that it travels to executors by value."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                done = 0
                with open(row["path"], "rb") as source, open(target, "r+b") as whole:
                    whole.seek(row["place"])
                    while chunk := source.read(min(chunk_bytes, row["size"] - done)):
                        whole.write(chunk)
                        done += len(chunk)
                yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["copied"])

    return copy


def _sized_parts(spark: SparkSession, directory: str) -> list[tuple[str, int]]:
    """Part files in the order in which Spark numbers them, and their sizes."""
    jpath, fs = hadoop_path(spark, directory)
    found = [s for s in fs.listStatus(jpath) if s.getPath().getName().startswith("part-")]
    return sorted((s.getPath().toString(), s.getLen()) for s in found)


def _filled(spark: SparkSession, directory: str) -> list[str]:
    """The part files that hold something; Spark writes one without rows for the first task."""
    jpath, fs = hadoop_path(spark, directory)
    found = [s for s in fs.listStatus(jpath) if s.getPath().getName().startswith("part-")]
    for status in found:
        if status.getLen() == 0:
            fs.delete(status.getPath(), False)
    return sorted(s.getPath().toString() for s in found if s.getLen() > 0)


def _rename(spark: SparkSession, names: list[tuple[str, str]]) -> None:
    """Give files new names, many at a time in tasks; one after another in stores that only Spark can open."""
    jpath, fs = hadoop_path(spark, names[0][0])
    if byteranges.can_open(fs.makeQualified(jpath).toUri().toString()):
        pairs = [tuple(_escaped_uri(name) for name in pair) for pair in names]
        frame = spark.createDataFrame(pairs, "old string, new string").repartition(spark.sparkContext.defaultParallelism)
        moved = frame.mapInArrow(_mover(), "moved bigint").agg(F.coalesce(F.sum("moved"), F.lit(0)).alias("n")).first()["n"]
        if moved != len(names):
            raise OutputError(f"Only {moved} of {len(names)} files got their names")
    else:
        for old, new in names:
            fs.rename(hadoop_path(spark, old)[0], hadoop_path(spark, new)[0])


def _escaped_uri(path: str) -> str:
    """``path``, which has a scheme, as a URI."""
    head, _, name = path.rpartition("/")
    scheme, colon, rest = head.partition(":")
    return f"{scheme}{colon}{'/'.join(map(escaped, rest.split('/')))}/{escaped(name)}"


def _mover() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Moves files; one that a task before it has moved already counts too. Nested so that it travels by value."""
    address_of = byteranges.address_of

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for row in batch.to_pylist():
                (store, old), (_, new) = (pafs.FileSystem.from_uri(address_of(row[k])) for k in ("old", "new"))
                if store.get_file_info(old).type != pafs.FileType.NotFound:
                    store.move(old, new)
                done += store.get_file_info(new).type == pafs.FileType.File
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["moved"])

    return move


def _header_first() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    header = HEADER_LINE

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            if batch.num_rows and not begun:
                yield pa.RecordBatch.from_arrays([pa.array([header.encode()], pa.binary())], names=["value"])
                begun = True
            yield pa.RecordBatch.from_arrays([batch.column("value")], names=["value"])

    return lines


def write_sample(lines: DataFrame, directory: str) -> None:
    """Kept lines, verbatim, as ``.csv`` files that each start with a header.

    One file per scanned partition that has kept lines: a sample of a large input is itself large and
    stays spread out. A sample without lines is one file with a header.
    """
    spark = lines.sparkSession
    ensure_new(spark, directory)
    staged = staging_path(directory)
    try:
        headed = lines.select(F.col("value").cast("binary")).mapInArrow(_header_first(), "value binary")
        headed.select(F.col("value").cast("string")).write.mode("errorifexists").text(staged)
        parts = _filled(spark, staged)
        if not parts:
            empty = spark.range(1).select(F.lit(HEADER_LINE).alias("value")).coalesce(1)
            empty.write.mode("overwrite").text(staged)
            parts = _filled(spark, staged)
        _rename(spark, [(part, part.removesuffix(".txt") + ".csv") for part in parts])
        publish(spark, staged, directory)
    finally:
        discard(spark, staged)


def write_artifact(rows: DataFrame, path: str) -> None:
    """Rows as JSON objects, create-only."""
    spark = rows.sparkSession
    ensure_new(spark, path)
    staged = staging_path(path)
    try:
        rows.write.mode("errorifexists").json(staged)
        publish(spark, staged, path)
    finally:
        discard(spark, staged)
