"""A data source of delimited UTF-16 files whose parts of bytes are read by many tasks.

Spark's own reader streams such a file through one task, since a line's end is
two bytes there. Here a task takes the lines that begin in its range of bytes.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a task's range, and of one read.
RANGE_BYTES = 32 << 20
READ_BYTES = 1 << 20
#: Rows of an Arrow batch.
BATCH_ROWS = 10_000
PATH = "path"


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _codec(mark: bytes) -> tuple[str, int]:
    """Codec and length of the byte order mark; without one little-endian."""
    if mark == b"\xfe\xff":
        return "utf-16-be", 2
    return "utf-16-le", 2 if mark == b"\xff\xfe" else 0


def lines_of(file, start: int, end: int) -> Iterator[str]:
    """Lines that begin in [start, end) of an open file, without their ends.

    `start` and `end` count from the first character and are even. A line
    begins at the start of the file or after a line feed, so a range leaves the
    line that it begins in the middle of to the range before.
    """
    file.seek(0)
    codec, skip = _codec(file.read(2))
    feed = "\n".encode(codec)
    at = start - 2 if start else 0  # the character before tells if a line begins here
    file.seek(skip + at)
    # The rest of a line, and the place of its first byte.
    held, place, inside = b"", at, start > 0
    while True:
        data = file.read(READ_BYTES)
        last = not data
        held += data
        done = 0
        while True:
            cut = held.find(feed, done)
            while cut >= 0 and cut % 2:  # half of one character and half of the next
                cut = held.find(feed, cut + 1)
            if cut < 0:
                break
            if not inside:
                if place + done >= end:
                    return
                yield held[done:cut].decode(codec, "replace").removesuffix("\r")
            inside, done = False, cut + 2
        if last:
            if not inside and done < len(held) and place + done < end:
                yield held[done:].decode(codec, "replace").removesuffix("\r")
            return
        if not inside and place + done >= end:
            return
        held, place = held[done:], place + done


class Utf16Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.names = [f.name for f in schema if f.name != PATH]
        self.paths = options["paths"].split("\n")
        self.separator = options["sep"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES)) // 2 * 2

    def partitions(self) -> list[ByteRange]:
        """Ranges of all files; only their sizes are asked for."""
        ranges = []
        places = [(*opened(p), p) for p in self.paths]
        for where, group in groupby(places, key=lambda place: place[0]):
            group = list(group)
            for (_, _, path), info in zip(group, where.get_file_info([inner for _, inner, _ in group])):
                ends = range(0, info.size, self.range_bytes)
                ranges += [ByteRange(path, a, min(a + self.range_bytes, info.size)) for a in ends]
        return ranges

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        where, inner = opened(part.path)
        width = len(self.names)
        schema = pa.schema([(n, pa.string()) for n in [*self.names, PATH]])

        def batch(rows: list[list]) -> pa.RecordBatch:
            columns = [pa.array(c, pa.string()) for c in zip(*rows)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([part.path] * len(rows))], schema=schema)

        with where.open_input_file(inner) as file:
            lines = lines_of(file, part.start, part.end)
            if part.start == 0:
                head = next(csv.reader([next(lines, "")], delimiter=self.separator), [])
                if head != self.names:
                    raise ValueError(f"header of {part.path} is {head}, not {self.names}")
            rows = []
            for line in lines:
                if not line.strip():
                    continue
                if line.count('"') % 2:
                    raise ValueError(f"{part.path}: a quoted cell goes on after its line; read the file with multi_line")
                # An empty cell is unknown; missing cells too, and surplus ones go.
                cells = [c or None for c in next(csv.reader([line], delimiter=self.separator))[:width]]
                rows.append(cells + [None] * (width - len(cells)))
                if len(rows) == BATCH_ROWS:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


class Utf16Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "utf16_files"

    def schema(self) -> T.StructType:
        raise ValueError("give the files' columns as the schema")

    def reader(self, schema: T.StructType) -> Utf16Reader:
        return Utf16Reader(schema, self.options)


def read_utf16(
    spark: SparkSession, paths: list[str], separator: str, header: list[str], range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Text columns of files with one header, and the `path` of each row's file.

    Undecodable bytes are replaced, empty cells are NULL, quotes in quoted cells
    are doubled. A quoted cell that holds a line's end is an error.
    """
    # Executors need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Utf16Files)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, PATH]])
    return (
        spark.read.format("utf16_files").schema(schema)
        .options(paths="\n".join(paths), sep=separator, rangeBytes=str(range_bytes)).load()
    )
