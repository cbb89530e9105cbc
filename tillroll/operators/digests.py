"""Digests that are sums, so that any task can take any lines: of whole inputs, and of blocks of them under a tree.

A line is hashed to 256 bits and its eight words of 32 bits are added up. Unlike an exclusive or, a sum tells how often a
line occurs. Sums are formed in the tasks; only sums are shuffled, never lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.sums import exact_sum
from tillroll.session import fail_if, materialize, select_in_steps

WORDS = tuple(f"w{i}" for i in range(8))
#: So many bytes have fewer lines than it takes for a sum of 32-bit words to leave a bigint.
REGION_BYTES = 1 << 31


def with_words(rows: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and the words of the SHA-256 of the SQL expression ``text``."""
    word = [f"CAST(conv(substring(hash, {1 + 8 * i}, 8), 16, 10) AS BIGINT) AS {w}" for i, w in enumerate(WORDS)]
    return select_in_steps(rows, [*keep, f"sha2(CAST({text} AS BINARY), 256) AS hash"], [*keep, *word])


def with_quick_words(rows: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """:func:`with_words` by four 64-bit hashes, many times cheaper; they are not made to withstand forgery."""
    hashes = [f"xxhash64({i}, {text}) AS h{i}" for i in range(4)]
    word = [f"h{i // 2} & 4294967295L AS {w}" if i % 2 else f"shiftrightunsigned(h{i // 2}, 32) AS {w}" for i, w in enumerate(WORDS)]
    return select_in_steps(rows, [*keep, *hashes], [*keep, *word])


def word_sums() -> list[Column]:
    return [exact_sum(w).alias(w) for w in WORDS]


def merged_words() -> list[Column]:
    """Sums of sums, of which there may be any number, modulo ``2 ** 64``."""
    return [F.expr(f"CAST(sum(CAST({w} AS DECIMAL(38,0))) % 18446744073709551616BD AS DECIMAL(20,0))").alias(w) for w in WORDS]


def words_digest(*more: str) -> Column:
    """SHA-256 over ``more`` columns and the sums, as text."""
    parts = ", ".join(f"CAST({c} AS STRING)" for c in (*more, *WORDS))
    return F.expr(f"sha2(CAST(concat_ws(':', {parts}) AS BINARY), 256)")


def line_digest(lines: DataFrame) -> DataFrame:
    """``uri, bytes, sha256`` per file or slice, from ``uri, offset, value``.

    Each line is hashed with its position, so changed, lost, added, repeated and moved lines are all told. It is a digest of
    the lines, not that of the file's bytes.
    """
    keep = ("uri", "CAST(octet_length(value) + 1 AS BIGINT) AS size", f"offset div {REGION_BYTES} AS region")
    hashed = select_in_steps(lines, [*keep, "concat_ws(':', CAST(offset AS STRING), value) AS text"])
    hashed = with_words(hashed, "text", ("uri", "size", "region"))
    regions = hashed.groupBy("uri", "region").agg(exact_sum("size").alias("bytes"), F.count(F.lit(1)).alias("lines"), *word_sums())
    whole = regions.groupBy("uri").agg(exact_sum("bytes").alias("bytes"), exact_sum("lines").alias("lines"), *merged_words())
    return whole.select("uri", "bytes", words_digest("lines").alias("sha256"))


# Trees of block digests


@dataclass(frozen=True)
class Shape:
    """Blocks of ``block_bytes``; ``fanout`` neighbours under one node, ``height`` levels above the blocks.

    The standard shape covers a file of a pebibyte; of its nodes none has more than 1024 children. A file with more blocks
    than the tree has room for fails, unless the shape is that of a ``forest``: then it has several nodes at the top.
    """

    block_bytes: int = 1 << 20
    fanout: int = 1024
    height: int = 3
    forest: bool = False

    def __post_init__(self) -> None:
        if not (0 < self.block_bytes <= REGION_BYTES and self.fanout > 1 and self.height > 0):
            raise ValueError(f"Not a tree of blocks: {self}")


NODE_COLUMNS = ("uri", "level", "node", "first_byte", "last_byte", "lines", "sha256")


def blocks(lines: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Level 0 of the tree: a row for each block in which lines of ``uri, offset, value`` begin.

    A block takes the lines that begin in it, so the tasks of a scan that splits the file add up blocks on their own; a
    large file is as many groups as it has blocks, and no task needs all of it.
    """
    numbered = select_in_steps(
        lines,
        [
            "uri",
            f"offset div {shape.block_bytes} AS node",
            "CAST(offset AS BIGINT) AS first_byte",
            "offset + octet_length(value) AS last_byte",
            "concat_ws(':', CAST(offset AS STRING), value) AS text",
        ],
    )
    summed = with_words(numbered, "text", ("uri", "node", "first_byte", "last_byte")).groupBy("uri", "node").agg(
        F.min("first_byte").alias("first_byte"),
        F.max("last_byte").alias("last_byte"),
        F.count(F.lit(1)).alias("lines"),
        *word_sums(),
    )
    return summed.withColumns({"level": F.lit(0), "sha256": words_digest("lines")}).select(*NODE_COLUMNS)


def _parents(nodes: DataFrame, level: int, shape: Shape) -> DataFrame:
    """The nodes above ``nodes``: each digest is over the numbers and digests of its children, ``fanout`` at most."""
    child = F.struct("node", F.concat_ws(":", F.col("node").cast("string"), "sha256").alias("text"))
    above = nodes.groupBy("uri", F.expr(f"node div {shape.fanout} AS node")).agg(
        F.min("first_byte").alias("first_byte"),
        F.max("last_byte").alias("last_byte"),
        exact_sum("lines").alias("lines"),
        F.array_sort(F.collect_list(child)).alias("children"),
    )
    digest = F.sha2(F.array_join("children.text", "\n").cast("binary"), 256)
    return above.withColumns({"level": F.lit(level), "sha256": digest}).select(*NODE_COLUMNS)


def tree(lines: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """All nodes of the tree of every file, from ``level`` 0, the blocks, to the one root at ``shape.height``.

    The input is read once; a level is made from the one below it. A file with more blocks than the shape has room for
    fails, or has as many roots as it takes if the shape is that of a forest.
    """
    nodes = materialize(blocks(lines, shape))
    levels = [nodes]
    for level in range(1, shape.height + 1):
        nodes = _parents(nodes, level, shape)
        if level == shape.height and not shape.forest:
            message = F.concat(F.lit("More blocks than the tree has room for: "), F.col("uri"))
            nodes = nodes.withColumn("node", fail_if(F.col("node") > 0, message, F.col("node")))
        nodes = materialize(nodes)
        levels.append(nodes)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def roots(nodes: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """``uri, bytes, sha256``: a manifest of roots. ``bytes`` counts up to the end of the last line."""
    if shape.forest:
        raise ValueError("A file may have several roots in a forest")
    top = nodes.where(F.col("level") == shape.height)
    return top.select("uri", (F.col("last_byte") + 1).alias("bytes"), "sha256")


def tree_drift(before: DataFrame, after: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """``uri, first_byte, last_byte, change`` of the blocks in which two trees of one shape differ.

    Both trees are descended from their roots: only children of nodes that differ are compared, so equal files cost one row
    each. ``change`` is ``missing`` for a block that is gone, ``added`` for a new one and ``content`` otherwise.
    """
    found = None
    for level in range(shape.height, -1, -1):
        left, right = (t.where(F.col("level") == level).drop("level") for t in (before, after))
        if found is not None:
            # The parents that differ, few as a rule; Spark broadcasts them if they are.
            parents = found.select("uri", F.col("node").alias("parent"))
            left, right = (
                t.withColumn("parent", F.expr(f"node div {shape.fanout}")).join(parents, ["uri", "parent"], "left_semi")
                for t in (left, right)
            )
        sides = [
            t.select("uri", "node", *(F.col(c).alias(f"{c}_{s}") for c in ("first_byte", "last_byte", "sha256")))
            for t, s in ((left, "0"), (right, "1"))
        ]
        joined = sides[0].join(sides[1], ["uri", "node"], "full_outer").where(~F.col("sha256_0").eqNullSafe(F.col("sha256_1")))
        found = materialize(joined)
        if found.isEmpty():
            break
    change = F.when(F.col("sha256_1").isNull(), "missing").when(F.col("sha256_0").isNull(), "added").otherwise("content")
    return found.select(
        "uri",
        F.least("first_byte_0", "first_byte_1").alias("first_byte"),
        F.greatest("last_byte_0", "last_byte_1").alias("last_byte"),
        change.alias("change"),
    )
