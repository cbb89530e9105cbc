"""Exact top-k search by inner product over a bit-sliced index.

The index keeps, for each block of rows and each component, one bitmap over the rows for every bit of the quantised
component. A query adds the slices of all components, weighted by its own, with carry-save adders on whole bitmaps; the
sum of every row then lies in slices again. Going from the most significant slice down, bitmap intersections and counts
narrow the rows to the k best; the rows that tie at the boundary are resolved by their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import parts_of, stored

_INDEX = "n_components int, block int, width int, ids binary, slices binary"
_LONG = (-(1 << 63), (1 << 63) - 1)


def quantise(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, q``: ``floor(scale * x)`` of each component as a double.

    Null vectors and vectors with null, infinite or NaN components are left out. A component that does not fit a long then
    fails the job.
    """

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        wide = F.raise_error(F.lit("A component of a vector is too large to be scaled to a long"))
        return F.when(F.abs(scaled) >= float(1 << 63), wide).otherwise(F.floor(scaled).cast("long"))

    q = F.transform(F.col("embedding"), whole)
    sound = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = rows.where(F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q")).where("vec_id is not null")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    values = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return np.concatenate([np.zeros(0, np.int64), *values]).reshape(len(column), width)


def slices_of(values: np.ndarray) -> tuple[int, np.ndarray]:
    """Bits a component needs, and bitmaps by component and bit of the values raised by ``2 ** (bits - 1)``."""
    most = int(np.abs(values).max(initial=0))
    width = most.bit_length() + 1
    raised = values.astype(np.uint64) + np.uint64(1 << (width - 1))  # modulo 2 ** 64, which it stays below
    words = -(-len(values) // 64)
    out = np.zeros((values.shape[1], width, words * 8), np.uint8)
    for bit in range(width):
        packed = np.packbits(((raised >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), axis=0, bitorder="little")
        out[:, bit, : packed.shape[0]] = packed.T
    return width, out.view("<u8").reshape(values.shape[1], width, words)


def index(vectors: DataFrame, rows_per_block: int = 32_768) -> DataFrame:
    """Blocks of the index of ``vec_id, q``: rows dealt by hash of the id, vectors of one length to a block."""
    blocks = parts_of(vectors.count(), rows_per_block)

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        values = _matrix(rows["q"], key[0].as_py())
        width, slices = slices_of(values)
        ids = rows["vec_id"].to_numpy().astype("<i8").tobytes()
        columns = [[key[0].as_py()], [key[1].as_py()], [width], [ids], [slices.tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in _INDEX.split(", ")])

    dealt = vectors.select(
        F.size("q").alias("n_components"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "q"
    )
    return dealt.groupBy("n_components", "block").applyInArrow(build, _INDEX)


def _add(columns: list[list[np.ndarray]]) -> list[np.ndarray | None]:
    """Sum of bitmaps by weight: three of one weight become one of it and a carry, until one of each is left."""
    out: list[np.ndarray | None] = []
    for place, maps in enumerate(columns):
        carries, at = [], 0
        while len(maps) - at > 2:
            a, b, c = maps[at : at + 3]
            half = a ^ b
            maps.append(half ^ c)
            carries.append((a & b) | (half & c))
            at += 3
        if len(maps) - at == 2:
            a, b = maps[at:]
            maps.append(a ^ b)
            carries.append(a & b)
        out.append(maps[-1] if maps else None)
        if carries:
            if place + 1 == len(columns):
                columns.append([])
            columns[place + 1] += carries
    return out


def _weighted_sum(slices: np.ndarray, query: np.ndarray, every: np.ndarray) -> tuple[list[np.ndarray | None], int]:
    """Slices of a row's score less ``base``, and ``base``.

    A raised component ``u`` is ``v + half``. A negative weight takes its complement ``top - u``, so all terms are
    positive and only constants remain.
    """
    width = slices.shape[1]
    half, top = 1 << (width - 1), (1 << width) - 1
    columns: list[list[np.ndarray]] = [[] for _ in range(width + int(np.abs(query).max(initial=0)).bit_length())]
    base = 0
    for own, weight in zip(slices, query.tolist(), strict=True):
        if weight < 0:
            own = own ^ every
            base -= weight * (half - top)
        else:
            base -= weight * half
        for shift in range(abs(weight).bit_length()):
            if abs(weight) >> shift & 1:
                for bit in range(width):
                    columns[bit + shift].append(own[bit])
    return _add(columns), base


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def best_rows(ids: np.ndarray, slices: np.ndarray, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The ``k`` best ``(vec_id, score)`` of one block, ties to the smaller id; rows with the query's id don't count."""
    inside = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
    every = np.zeros(slices.shape[2] * 8, np.uint8)
    every[: len(inside)] = inside
    every = every.view("<u8")
    total, base = _weighted_sum(slices, query, every)
    others = np.zeros(slices.shape[2] * 64, np.uint8)
    others[: len(ids)] = ids != query_id
    open_rows = np.packbits(others, bitorder="little").view("<u8")
    chosen, got = np.zeros_like(open_rows), 0
    for bitmap in reversed(total):
        if bitmap is None:
            continue
        upper = open_rows & bitmap
        found = _count(upper)
        if got + found > k:
            open_rows = upper
        else:
            chosen, got = chosen | upper, got + found
            open_rows = open_rows & ~bitmap
    tied = np.flatnonzero(np.unpackbits(open_rows.view(np.uint8), bitorder="little"))[: k - got]
    rows = np.concatenate((np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little")), tied)).tolist()
    out = []
    for row in rows:
        word, bit = row // 64, row % 64
        score = base + sum(1 << p for p, m in enumerate(total) if m is not None and int(m[word]) >> bit & 1)
        if not _LONG[0] <= score <= _LONG[1]:
            raise OverflowError(f"The score of {int(ids[row])} for {query_id} does not fit a long: {score}")
        out.append((int(ids[row]), score))
    return out


def search(queries: DataFrame, vectors: DataFrame, k: int = 10, rows_per_block: int = 32_768, queries_per_task: int = 512) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` with the greatest inner product for each query.

    Both tables have ``vec_id, q`` as ``quantise`` gives them. Ties go to the smaller ``vec_id``; rows with the query's
    own id are no candidates; only vectors of the query's length are. Repeated candidate rows count as rows, repeated
    queries as one; queries with one id and different vectors are ranked each for itself. Fewer candidates than ``k`` are
    all returned, none give no rows. Sums are exact whatever their size; a score among the best that does not fit a long
    fails the job.

    Blocks of rows meet chunks of queries under a key of both, a block of the index against one chunk in a row.
    """
    blocks, chunks = parts_of(vectors.count(), rows_per_block), parts_of(queries.count(), queries_per_task)
    keyed = stored(index(vectors, rows_per_block), "index").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )

    def gather(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        ids = rows["vec_id"].to_numpy().astype("<i8").tobytes()
        values = _matrix(rows["q"], key[0].as_py()).astype("<i8").tobytes()
        columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32())]
        return pa.table([*columns, pa.array([ids], pa.binary()), pa.array([values], pa.binary())], ["n_components", "chunk", "query_ids", "queries"])

    asked = queries.dropDuplicates(["vec_id", "q"]).select(
        F.size("q").alias("n_components"), F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"), "vec_id", "q"
    )
    asked = asked.groupBy("n_components", "chunk").applyInArrow(
        gather, "n_components int, chunk int, query_ids binary, queries binary"
    )
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                ids, wanted = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["query_ids"], "<i8")
                n = row["n_components"]
                slices = np.frombuffer(row["slices"], "<u8").reshape(n, row["width"], -1) if n else np.zeros((0, 1, -(-len(ids) // 64)), "<u8")
                values = np.frombuffer(row["queries"], "<i8").reshape(len(wanted), n)
                columns: list[list] = [[], [], [], []]
                for number, query_id in enumerate(wanted.tolist()):
                    for vec_id, score in best_rows(ids, slices, query_id, values[number], k):
                        for column, value in zip(columns, (query_id, row["chunk"] << 32 | number, vec_id, score), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "query", "vec_id", "score"])

    found = keyed.join(asked, ["n_components", "block", "chunk"]).mapInArrow(
        run, "query_id long, query long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
