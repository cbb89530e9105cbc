"""Session helpers: the shared folder and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A private temporary folder is used only with ``local`` or ``local[n]`` as master and the setting
    absent: there driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-"))
    return spark.sparkContext.getCheckpointDir()


_USED: list[tuple[SparkSession, str]] = []


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used yet; it is deleted when the program ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _USED:
        atexit.register(drop_intermediate)
    _USED.append((spark, path))
    return path


def drop_intermediate() -> None:
    """Delete what lies at the paths of :func:`new_shared_path`; frames that read it are spent then."""
    while _USED:
        spark, path = _USED.pop()
        with contextlib.suppress(Exception):  # the session may be gone, and its folder with it
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once into reliable storage, so a lost executor cannot force a re-scan."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def select_in_steps(df: DataFrame, *steps: list[str]) -> DataFrame:
    """One select after another, each seeing the columns of the one before, as a single statement.

    Spark analyses a statement once; a chain of ``selectExpr`` calls would be analysed at every link.
    """
    query = "{source}"
    for step in steps:
        columns = ", ".join(step).replace("{", "{{").replace("}", "}}")
        query = f"(SELECT {columns} FROM {query})"
    return df.sparkSession.sql(query[1:-1], source=df)


def fail_if(condition: Column, message: Column | str, value: Column) -> Column:
    """``value``, or a failed job as soon as one row meets ``condition``."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, F.raise_error(text)).otherwise(value)


def row_count(df: DataFrame) -> Column:
    """The number of rows of ``df`` as a scalar subquery, known before the outer stage starts."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()
