"""Byte-level BPE encoding and decoding over contiguous rank arrays."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Fixed value: how byte-level BPE of this vocabulary splits a text into words.
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Words of more bytes than this are merged from a heap; the scan's work grows with their square.
_SHORT = 128
#: Words that each Python worker remembers, and their greatest length.
_REMEMBERED, _REMEMBERED_LENGTH = 800_000, 64
_NONE = 1 << 60
_SHARED: dict = {}


def _byte_letters() -> dict[str, int]:
    """The letters in which vocabulary files of byte-level BPE write bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


#: Planes of Unicode that have letters or digits; the rest is private, unassigned, or for marks.
_PLANES = (0x00, 0x01, 0x02, 0x03, 0x0E)


@functools.cache
def _disputed(path: str) -> dict[int, str]:
    """Characters that the tokenizers library takes for a letter, digit or neither where the ``regex`` package differs.

    The two know different versions of Unicode. The library's own splitter is asked about every character: one that stays
    with a letter before it is a letter, one that stays with a digit a digit. Each is mapped to a character of its class
    that no rule of the splitter names.
    """
    splitter = Tokenizer.from_file(path).pre_tokenizer
    kinds = [(regex.compile(r"\p{L}"), "a", "z"), (regex.compile(r"\p{N}"), "1", "0")]
    found: dict[int, str] = {}
    for plane in _PLANES:
        for start in range(plane << 16, (plane + 1) << 16, 1 << 12):
            chars = [chr(c) for c in range(max(start, 128), start + (1 << 12)) if not 0xD800 <= c < 0xE000]
            for known, before, stand_in in kinds:
                # Each character stands between a letter (or digit) and a mark; a word that has both tells its class.
                pieces = splitter.pre_tokenize_str("".join(f"{before}{c}\n" for c in chars))
                begins = {at for _, (at, _) in pieces}
                for number, char in enumerate(chars):
                    joined = 3 * number + 1 not in begins
                    if joined != bool(known.match(char)):
                        found[ord(char)] = stand_in if joined else found.get(ord(char), "#")
    return found


class Bpe:
    """Encoder and decoder of one vocabulary file.

    Merging works on ids: ``ranks`` has for two adjacent ids the rank of their merge and the id of the result.
    """

    def __init__(self, path: str, disputed: dict[int, str] | None = None) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None
        self.words = regex.compile(_WORD)
        self.disputed = _disputed(path) if disputed is None else disputed
        self.high = re.compile(f"[{re.escape(chr(min(self.disputed)))}-\U0010ffff]") if self.disputed else None
        self.known: dict[str, tuple[int, bytes, bytes]] = {}

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        ids = [self.first[b] for b in word]
        return self._by_scan(ids) if len(ids) <= _SHORT else self._by_heap(ids)

    def _by_scan(self, ids: list[int]) -> list[int]:
        """``ids`` has a part's id at each boundary, ``at`` the rank of the part and its right neighbour."""
        ranks, none = self.ranks, (_NONE, 0)
        at = [ranks.get(pair, none) for pair in zip(ids, ids[1:], strict=False)]
        while at:
            low = min(at)
            if low[0] == _NONE:
                break
            i = at.index(low)
            ids[i] = low[1]
            del ids[i + 1], at[i]
            if i < len(at):
                at[i] = ranks.get((ids[i], ids[i + 1]), none)
            if i:
                at[i - 1] = ranks.get((ids[i - 1], ids[i]), none)
        return ids

    def _by_heap(self, ids: list[int]) -> list[int]:
        """The same merges for a long word: linked parts, and a heap of ranks in which old entries are passed over."""
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(*self.ranks[p], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, merged, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b >= 0 and (found := self.ranks.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (*found, a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]

    def split(self, text: str) -> Iterator[str]:
        """Words in order; a special token is a word of its own."""
        start = 0
        for match in self.cut.finditer(text) if self.cut else ():
            yield from self._plain(text[start : match.start()])
            yield match.group()
            start = match.end()
        yield from self._plain(text[start:] if start else text)

    def _plain(self, text: str) -> list[str]:
        """Words of a text without special tokens. Disputed characters are split by what stands in for them."""
        if self.high and self.high.search(text):
            stood_in = text.translate(self.disputed)
            if stood_in != text:
                return [text[m.start() : m.end()] for m in self.words.finditer(stood_in)]
        return self.words.findall(text)

    def ids(self, word: str) -> list[int]:
        return [self.special[word]] if word in self.special else self.merge(word.encode())

    def encode(self, text: str) -> list[int]:
        return [i for word in self.split(text) for i in self.ids(word)]

    def raw(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.raw(ids).decode("utf-8", "replace")

    def word(self, word: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids in decimal with a comma after each, and the bytes that they decode to; remembered."""
        found = self.known.get(word)
        if found is None:
            ids = self.ids(word)
            found = len(ids), "".join([f"{i}," for i in ids]).encode(), self.raw(ids)
            if len(word) <= _REMEMBERED_LENGTH:
                if len(self.known) >= _REMEMBERED:
                    self.known.clear()
                self.known[word] = found
        return found


def _bpe(path: str, disputed: dict[int, str]) -> Bpe:
    if path not in _SHARED:
        _SHARED[path] = Bpe(path, disputed)
    return _SHARED[path]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids`` of every row. Null and empty texts have no ids; other columns are ignored."""
    disputed = _disputed(tokenizer)  # found once, by the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizer, disputed)
        for batch in batches:
            ids = pa.array([bpe.encode(t.as_py()) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``; null ids give an empty text."""
    disputed = _disputed(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizer, disputed)
        for batch in batches:
            texts = pa.array([bpe.decode(i.as_py() or []) for i in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encoded, and decoded again, in one pass.

    Null and empty texts have no tokens and the digests of nothing. Rows stay as they are: repeated rows and null ids are
    kept, other columns ignored, an empty table gives no rows. A word of any length is encoded whole.
    """
    disputed = _disputed(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, names = _bpe(tokenizer, disputed), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in batch.column(1):
                words = [bpe.word(w) for w in bpe.split(text.as_py())]
                counts.append(sum([w[0] for w in words]))
                digests.append(hashlib.sha256(b"".join([w[1] for w in words])[:-1]).hexdigest())
                whole = b"".join([w[2] for w in words]).decode("utf-8", "replace")
                decoded.append(hashlib.sha256(whole.encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
