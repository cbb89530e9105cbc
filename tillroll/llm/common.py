"""What the operators of this folder share: tables, stored intermediates and connected components."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import new_shared_path

#: What holds while a table is stored: shuffle files go with the end of the write, and a batch of rows for Python is of
#: so many bytes at most (a single larger row is a batch). Spark's own limit is a number of rows, of any size.
_STORING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back.

    Cuts the lineage: what reads it twice computes it once, and a lost executor costs a read, not the work. The shuffle
    files of the write are deleted with its end, not when the driver happens to collect garbage.
    """
    path = new_shared_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in _STORING}
    try:
        for key, value in _STORING.items():
            conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _give_back() -> None:
    """Hand memory that is free within this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def map_batches(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``rows.mapInArrow``; a Python worker, which waits for further tasks, does not keep what a task has freed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return rows.mapInArrow(task, schema)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def parts_of(amount: int, each: int) -> int:
    """How many parts of at most about ``each`` hold ``amount``; one at least."""
    return max(1, math.ceil(amount / each))


def parity_bits(hashes: str) -> list[Column]:
    """256 bits of a set of hashes, as columns ``s0`` to ``s3``: a bit says whether an odd number of hashes falls on it.

    Two sets differ in as many hashes as in bits, at least."""
    return [
        F.expr(
            f"aggregate({hashes}, 0L, (a, x) -> if((shiftrightunsigned(x, 6) & 3) = {k}, a ^ shiftleft(1L, CAST(x & 63 AS INT)), a))"
        ).alias(f"s{k}")
        for k in range(4)
    ]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of the undirected graph of ``links(u, v)``; a component is named by its smallest node.

    Each round every node takes its smallest neighbour (or itself), follows that pointer once more, and the graph is
    contracted along the pointers. Nodes at least halve along every path, so the rounds are logarithmic, and only tables
    of the size of the remaining graph move. Links of a node to itself and nulls are ignored; no links, no rows.
    """
    edges = stored(
        links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links"
    )
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("p"))
        further = nearest.select(F.col("u").alias("p"), F.col("p").alias("q"))
        pointers = stored(nearest.join(further, "p").select("u", F.col("q").alias("p")), "pointers")
        if labels is None:
            labels = pointers.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            moved = pointers.select(F.col("u").alias("component"), "p")
            labels = labels.join(moved, "component", "left").select(
                "node", F.coalesce("p", "component").alias("component")
            )
            labels = stored(labels, "labels")
        low = pointers.select("u", F.col("p").alias("pu"))
        high = pointers.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = stored(
            edges.join(low, "u")
            .join(high, "v")
            .where("pu <> pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .distinct(),
            "links",
        )
    if labels is None:
        labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
