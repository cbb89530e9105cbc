"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm.common import map_batches, parts_of, stored

#: Chunks between spaces whose ids each Python worker remembers, and their greatest length.
_REMEMBERED, _REMEMBERED_LENGTH = 1_000_000, 64
#: Marks that end a word of Latin letters before a blank or the end.
_MARKS = r"([a-z\x{df}-\x{f6}\x{f8}-\x{ff}\x{c0}-\x{d6}\x{d8}-\x{de}])([.,;:!?]+)( |$)"
#: Text that is encoded at once.
_SLICE_BYTES = 4 << 20
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SHARED: dict = {}


class _Encoder:
    """Ids of whole texts, for tokenizers that drop white space, lower-case, and part letters from marks.

    White space ends a word in such a tokenizer, so a text's ids are those of its chunks between spaces and line ends.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}

    def _ids(self, chunks: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return {c: np.array(e.ids, "<u4").tobytes() for c, e in zip(chunks, found, strict=True)}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin; the last number is where all end.

        Different chunks are looked up or encoded once; the ids of all are gathered from theirs.
        """
        texts = texts.take(pa.array(np.arange(len(texts))))  # a copy: slices share buffers with what lies before them
        plain = pc.replace_substring(texts.cast(pa.large_string()), "\n", " ")
        if not pc.any(pc.match_substring(plain, "<|"), min_count=0).as_py():
            # The tokenizer lower-cases all but its special tokens, and parts letters from the marks behind them.
            plain = pc.replace_substring_regex(pc.ascii_lower(plain), _MARKS, r"\1 \2\3")
        parted = pc.split_pattern(plain, " ")
        chunks = parted.flatten().dictionary_encode()
        which, different = chunks.indices.to_numpy(zero_copy_only=False), chunks.dictionary.to_pylist()
        known = self.known
        new = [c for c in different if c not in known]
        fresh = self._ids(new) if new else {}
        found = [known[c] if c in known else fresh[c] for c in different]
        if len(known) + len(new) > _REMEMBERED:
            known.clear()
        known.update((c, i) for c, i in fresh.items() if len(c) <= _REMEMBERED_LENGTH)
        size = np.fromiter((len(f) // 4 for f in found), np.int64, len(found))
        ids, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        sizes = size[which]
        ends = np.append(0, np.cumsum(sizes))
        places = np.arange(ends[-1]) + np.repeat(first[which] - ends[:-1], sizes)
        return ids[places], ends[parted.offsets.to_numpy()]


def _encoder(path: str) -> _Encoder:
    if path not in _SHARED:
        _SHARED[path] = _Encoder(path)
    return _SHARED[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of ``capacity`` tokens; only the last may be shorter."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, names = _encoder(tokenizer), [f.split()[0] for f in _PIECES.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // _SLICE_BYTES
            cuts = np.flatnonzero(np.diff(part)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                ids, bounds = encoder.encode(batch.column(1)[start:stop])
                columns: list[list] = [[], [], [], [], []]
                for row, doc_id in enumerate(batch.column(0)[start:stop].to_pylist()):
                    own = ids[bounds[row] : bounds[row + 1]].tobytes() + end
                    for number, at in enumerate(range(0, len(own), 4 * capacity)):
                        piece = own[at : at + 4 * capacity]
                        for column, value in zip(columns, (doc_id, number, at // 4, len(piece) // 4, zlib.crc32(piece)), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return map_batches(rows, run, _PIECES)


class BestFit:
    """Online best fit over at most ``open_bins`` bins.

    A bitset has bit ``f`` set while a bin with ``f`` free places is open, so the tightest bin that holds ``size`` is its
    lowest bit from ``size`` upward. If all are open and none fits, the fullest closes: the lowest bit of all.
    """

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0
        self.bins: dict[int, list[int]] = {}
        self.opened = self.still_open = 0

    def _take(self, free: int) -> int:
        bins = self.bins[free]
        number = bins.pop()
        if not bins:
            self.free &= ~(1 << free)
        self.still_open -= 1
        return number

    def put(self, size: int) -> tuple[int, int]:
        """The number of the bin and the offset in it."""
        fitting = self.free >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.still_open >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            number, free = self.opened, self.capacity
            self.opened += 1
        rest = free - size
        if rest:
            self.bins.setdefault(rest, []).append(number)
            self.free |= 1 << rest
            self.still_open += 1
        return number, self.capacity - free


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    open_bins: int = 512,
    bins_per_task: int = 16_384,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document.

    Pieces are dealt by hash to tasks of about ``bins_per_task`` sequences and packed there in the order of their ids, so
    the same rows give the same sequences when a task runs again. Only the pieces' sizes move, never tokens. Null and empty
    texts have the end id alone. Repeated rows are packed each for itself. Null ids are kept. Other columns are ignored;
    an empty table gives no rows.
    """
    cut = stored(pieces(docs, tokenizer, capacity, end_id), "pieces")
    total = cut.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    dealt = cut.repartition(parts_of(total, capacity * bins_per_task), F.xxhash64("doc_id", "piece", "ids_crc32"))
    schema = f"{_PIECES}, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, first = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 32
        for batch in batches:
            places = [fit.put(size) for size in batch.column("length").to_pylist()]
            numbers = pa.array([first + n for n, _ in places], pa.int64())
            offsets = pa.array([o for _, o in places], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, numbers, offsets], [*batch.schema.names, "sequence_id", "offset"]
            )

    return map_batches(dealt.sortWithinPartitions("doc_id", "piece", "ids_crc32"), run, schema)
