"""Lines of files with their byte offsets, each byte read once.

A task takes byte ranges of files and owns the lines that begin in them: it skips to the first line that does, and reads on
past the end of its range until the last one is whole. So the place of a line is known where it is read; nothing has to be
known of other ranges.
"""

from __future__ import annotations

import json
import re
import sys
import urllib.parse
import weakref
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

# What tasks need of this module travels with them: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SOURCE = "tillroll_lines"
SCHEMA = "uri string, offset bigint, value binary"
#: Schemes of stores that tasks can open themselves.
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")
_READ_BYTES = 8 << 20

_KNOWN: weakref.WeakSet[SparkSession] = weakref.WeakSet()


def can_open(uri: str) -> bool:
    return uri.partition(":")[0] in SCHEMES


def address_of(uri: str) -> str:
    """``uri`` as Arrow's file systems take it."""
    uri = re.sub(r"[^\x00-\x7f]+", lambda found: urllib.parse.quote(found.group()), uri)
    if uri.startswith("file:/") and not uri.startswith("file://"):
        return uri.replace("file:/", "file:///", 1)
    return "s3:" + uri[4:] if uri.startswith("s3a:") else uri


def tasks_of(files: Sequence[tuple[str, int]], task_bytes: int) -> list[list[tuple[str, int, int]]]:
    """Ranges ``(uri, start, end)`` of ``(uri, bytes)`` for each task: parts of a large file, or some small files."""
    tasks: list[list[tuple[str, int, int]]] = [[]]
    room = task_bytes
    for uri, size in files:
        for start in range(0, size, task_bytes):
            end = min(size, start + task_bytes)
            if tasks[-1] and end - start > room:
                tasks.append([])
                room = task_bytes
            tasks[-1].append((uri, start, end))
            room -= end - start
    return tasks


def line_source() -> type[DataSource]:
    """The data source class, with the sizes that hold now."""
    plan, address, read_bytes, schema = tasks_of, address_of, _READ_BYTES, SCHEMA

    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Ranges(InputPartition):
        def __init__(self, ranges: list[tuple[str, int, int]]) -> None:
            super().__init__(None)
            self.ranges = ranges

    class Reader(DataSourceReader):
        def __init__(self, options) -> None:
            self.files = json.loads(options["files"])
            self.task_bytes = int(options["taskBytes"])

        def partitions(self) -> list[InputPartition]:
            return [Ranges(t) for t in plan(self.files, self.task_bytes)]

        def read(self, partition: Ranges):
            for uri, start, end in partition.ranges:
                yield from lines_of(uri, start, end)

    def lines_of(uri: str, start: int, end: int):
        import pyarrow.fs as pafs

        store, path = pafs.FileSystem.from_uri(address(uri))
        with store.open_input_file(path) as stream:
            # The byte before the range tells whether a line begins with it.
            place = max(0, start - 1)
            stream.seek(place)
            held, skipping = b"", start > 0
            while True:
                chunk = stream.read(read_bytes)
                if skipping:
                    found = chunk.find(b"\n")
                    if found < 0:
                        place += len(chunk)
                        if not chunk or place >= end:
                            return
                        continue
                    chunk, place, skipping = chunk[found + 1 :], place + found + 1, False
                    if place >= end:
                        return
                    if not chunk:
                        continue
                held += chunk
                last = held.rfind(b"\n") + 1
                if not chunk and held:  # the last line of the file has no line end
                    held, last = held + b"\n", len(held) + 1
                if last:
                    yield batch(uri, place, held[:last], end)
                    place, held = place + last, held[last:]
                if not chunk or place >= end:
                    return

    def batch(uri: str, place: int, text: bytes, end: int):
        """Whole lines from ``place`` on, those that begin before ``end``."""
        import numpy as np
        import pyarrow as pa

        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
        starts = np.append(0, ends[:-1] + 1)
        count = int(np.searchsorted(starts + place, end))
        starts, ends = starts[:count], ends[:count]
        marked = place == 0 and text.startswith(b"\xef\xbb\xbf")
        first = starts.copy()
        if marked:
            first[0] = 3
        # Line ends are cut out, so values lie one after another.
        keep = np.ones(int(ends[-1]) + 1 if count else 0, bool)
        keep[ends] = False
        if marked:
            keep[:3] = False
        values = np.frombuffer(text, np.uint8)[: len(keep)][keep]
        bounds = np.append(0, np.cumsum(ends - first)).astype(np.int32)
        value = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(bounds), pa.py_buffer(values)])
        uris = pa.DictionaryArray.from_arrays(pa.array(np.zeros(count, np.int32)), pa.array([uri])).cast(pa.string())
        return pa.RecordBatch.from_arrays([uris, pa.array(starts + place), value], ["uri", "offset", "value"])

    class Lines(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE_NAME

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    SOURCE_NAME = SOURCE
    return Lines


def scan(spark: SparkSession, files: Sequence[tuple[str, int]], task_bytes: int) -> DataFrame:
    """``uri, offset, value`` (binary) of every line of the files named ``(uri, bytes)``.

    Only LF ends a line. A byte order mark at the start of a file belongs to no value. Lines that a file gains beyond the
    stated bytes are not read; the line that the last stated byte is in is read whole.
    """
    if spark not in _KNOWN:
        spark.dataSource.register(line_source())
        _KNOWN.add(spark)
    reader = spark.read.format(SOURCE).option("files", json.dumps(list(files))).option("taskBytes", str(task_bytes))
    return reader.load()
