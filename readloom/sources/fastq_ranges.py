"""FASTQ by byte range: a Python data source with one Spark partition per range.

A read belongs to the range in which its header starts, so ranges need no shuffle and no second
pass. Whether a line is a header is decided from the line itself and the three behind it: it
starts with ``@``, the line two below starts with ``+``, and the lines one and three below are
equally long. That makes the result the same for every range size, and drops broken records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, block long, seq long, header string, bases string, qual string"
PIECE = 8 << 20
# Extensions of codecs that are read as one stream, as they cannot be split, and of those that Arrow lacks.
STREAMED, UNREAD = {"gz", "bz2", "zst", "lz4"}, {"deflate", "snappy", "xz", "Z", "zip", "lzo"}


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int | None):
        super().__init__((path, start, end))


class FastqRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FastqRangeReader(self.options["path"].split("\n"), int(self.options["rangebytes"]))


class FastqRangeReader(DataSourceReader):
    def __init__(self, paths: list[str], range_bytes: int):
        self.paths, self.range_bytes = paths, range_bytes

    def partitions(self) -> list[InputPartition]:
        ranges: list[InputPartition] = []
        for path in self.paths:
            for info in _files(path):
                if info.extension in UNREAD:
                    raise ValueError(f"{info.path}: this reader has no {info.extension} codec; use read_fastq")
                if info.extension in STREAMED:
                    ranges.append(ByteRange(_uri(path, info.path), 0, None))
                    continue
                for start in range(0, info.size, self.range_bytes):
                    end = min(start + self.range_bytes, info.size)
                    ranges.append(ByteRange(_uri(path, info.path), start, end))
        return ranges

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, end = partition.value
        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_stream(inner) if end is None else store.open_input_file(inner) as stream:
            for at, lines, picked in _pieces(stream, start, end):
                yield _batch(path, start, at, lines, picked)


def _files(path: str):
    store, inner = fs.FileSystem.from_uri(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.Directory:
        found = store.get_file_info(fs.FileSelector(inner, recursive=True))
        return sorted(
            (f for f in found if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.path
        )
    return [info]


def _uri(given: str, inner: str) -> str:
    return given.split("://")[0] + "://" + inner if "://" in given else inner


def _pieces(stream, start: int, end: int | None):
    """Yield (byte place of every line, the lines, which lines are headers), piece by piece."""
    held, at = b"", start
    if start:
        # A range begins at the first line that starts in it.
        stream.seek(start - 1)
        at = start - 1
        while (cut := held.find(b"\n")) < 0:
            at += len(held)
            held = stream.read(PIECE)
            if not held:
                return
        held, at = held[cut + 1 :], at + cut + 1
    while end is None or at < end:
        more = stream.read(PIECE)
        if not more and held and not held.endswith(b"\n"):
            held += b"\n"
        buf = held + more
        data = np.frombuffer(buf, np.uint8)
        ends = np.flatnonzero(data == 10) + 1
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        whole = max(len(ends) - 3, 0)
        if whole:
            sizes = ends - starts
            picked = (
                (data[starts[:whole]] == ord("@"))
                & (data[starts[2 : whole + 2]] == ord("+"))
                & (sizes[1 : whole + 1] == sizes[3 : whole + 3])
            )
            if end is not None:
                picked &= starts[:whole] + at < end
            offsets = np.concatenate((starts, ends[-1:])).astype(np.int32)
            lines = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(buf))
            yield starts + at, lines, np.flatnonzero(picked)
            used = int(starts[whole]) if whole < len(starts) else int(ends[-1])
            held, at = buf[used:], at + used
        else:
            held = buf
        if not more:
            return


def _batch(path: str, block: int, at: np.ndarray, lines: pa.StringArray, picked: np.ndarray) -> pa.RecordBatch:
    text = lambda shift: pc.utf8_rtrim(lines.take(pa.array(picked + shift)), "\r\n")
    n = len(picked)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path]).take(pa.array(np.zeros(n, np.int64))),
            pa.array(np.full(n, block, np.int64)),
            pa.array(at[picked].astype(np.int64)),
            text(0),
            text(1),
            text(3),
        ],
        names=["file", "block", "seq", "header", "bases", "qual"],
    )


def read_fastq_ranges(spark: SparkSession, paths: str | list[str], range_bytes: int = 128 << 20) -> DataFrame:
    """Reads with equally long bases and qualities; ``block`` and ``seq`` are byte places."""
    spark.dataSource.register(FastqRanges)
    listed = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("fastq_ranges").option("rangebytes", str(range_bytes))
    return reader.load("\n".join(listed))
