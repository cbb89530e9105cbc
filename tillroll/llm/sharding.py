"""Sharding by Karmarkar-Karp differencing, in a tree of partial partitions."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import parts_of, stored

#: A subset of a partial partition: its size and the items (or subsets of the level below) in it.
Subset = tuple[int, list[int]]


def _combine(a: list[Subset], b: list[Subset], k: int) -> list[Subset]:
    """Two partial partitions in opposite order: the largest subset of one joins the smallest of the other.

    Both lists run from large to small; subsets that are not listed are empty.
    """
    out, over = [], len(a) + len(b) - k
    if over <= 0:
        out = a + b
    else:
        out = a[: len(a) - over] + b[: len(b) - over]
        for (x, left), (y, right) in zip(a[len(a) - over :], reversed(b[len(b) - over :]), strict=True):
            few, many = (left, right) if len(left) < len(right) else (right, left)
            many.extend(few)
            out.append((x + y, many))
    out.sort(key=lambda s: -s[0])
    return out


def difference(partials: list[list[Subset]], k: int) -> list[Subset]:
    """One partition into ``k`` subsets: the two partial ones with the largest spread are combined until one is left."""

    def entry(partial: list[Subset], number: int) -> tuple[int, int, list[Subset]]:
        low = partial[-1][0] if len(partial) == k else 0
        return -(partial[0][0] - low if partial else 0), number, partial

    heap = [entry(p, n) for n, p in enumerate(partials)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        first, second = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        heapq.heappush(heap, entry(_combine(first, second, k), number))
        number += 1
    return heap[0][2] if heap else []


def _level(rows: DataFrame, k: int) -> DataFrame:
    """``node, part, item, subset, size``: each node's partial partitions (``part``) made one; ``size`` is the subset's."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("size", "descending"), ("item", "ascending")])
        parts, sizes = table["part"].to_pylist(), table["size"].to_pylist()
        partials: list[list[Subset]] = []
        for at, part in enumerate(parts):
            if not at or part != parts[at - 1]:
                partials.append([])
            partials[-1].append((sizes[at], [at]))
        subset, size = [0] * len(parts), [0] * len(parts)
        for number, (total, members) in enumerate(difference(partials, k)):
            for at in members:
                subset[at], size[at] = number, total
        node = pa.array([key[0].as_py()] * len(parts), pa.int64())
        columns = [node, table["part"], table["item"], pa.array(subset, pa.int32()), pa.array(size, pa.int64())]
        return pa.table(columns, ["node", "part", "item", "subset", "size"])

    return rows.groupBy("node").applyInArrow(run, "node long, part long, item long, subset int, size long")


def balanced(groups: DataFrame, shards: int, per_task: int = 4_000, fan_in: int = 200) -> DataFrame:
    """``item, shard`` of groups ``item, size`` so that the shards' sizes come near to equal.

    Items are dealt by hash to nodes of about ``per_task``; differencing makes one partial partition of each. These are
    combined in the same way, ``fan_in`` nodes at a time, until one is left. A task holds one node's items or
    ``fan_in * shards`` subsets.
    """
    nodes = parts_of(groups.count(), per_task)
    rows = groups.select(F.pmod(F.col("item"), F.lit(nodes)).alias("node"), F.col("item").alias("part"), "item", "size")
    done = stored(_level(rows, shards), "level")
    placed = done.select("item", "node", "subset")
    while nodes > 1:
        nodes = parts_of(nodes, fan_in)
        subsets = done.select("node", "subset", "size").distinct()
        rows = subsets.select(
            F.pmod(F.col("node"), F.lit(nodes)).alias("node"),
            F.col("node").alias("part"),
            F.col("subset").cast("long").alias("item"),
            "size",
        )
        done = stored(_level(rows, shards), "level")
        above = done.select(
            F.col("part").alias("node"), F.col("item").cast("int").alias("subset"), F.col("node").alias("up"), F.col("subset").alias("to")
        )
        placed = placed.join(above, ["node", "subset"]).select("item", F.col("up").alias("node"), F.col("to").alias("subset"))
    return placed.select("item", F.col("subset").alias("shard"))


def assign(docs: DataFrame, shards: int = 40, overhead: int = 16, rows_per_cell: int = 50_000) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row, by the law ``bytes``.

    A row's size is its text's UTF-8 bytes and ``overhead``; null and empty texts count as equal. Rows of equal text
    (SHA-256) are a group that stays in one shard. Slots number a shard's rows from 0 without a gap, in the order of cells
    (by hash of the row) and of ``doc_id`` within; a cell is a task's share, so a full shard is no single task.
    Repeated rows have a slot each; null ids are kept; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "sizes",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    groups = stored(groups.withColumn("item", F.xxhash64("digest")), "groups")
    # items are 64-bit hashes; groups that share one are placed as one, which keeps equal texts together all the same
    items = groups.groupBy("item").agg(F.sum("size").alias("size"))
    placed = balanced(items, shards)
    cells = parts_of(rows.count(), rows_per_cell)
    cell = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(cells))
    dealt = stored(
        rows.withColumn("item", F.xxhash64("digest")).join(placed, "item").withColumn("cell", cell).drop("item"), "dealt"
    )
    counts = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "digest")) - 1
    numbered = dealt.withColumn("place", place).join(offsets, ["shard", "cell"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
