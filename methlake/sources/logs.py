"""Log files that grow, as a streaming source: a batch reads what was appended since the one before.

The offset of a stream is, for each file, its size and who it is: the inode where the file system has one, and digests of its first bytes and of the bytes before the
size. A file that is not the one it was (cut, or replaced by a shorter, equal or longer one) is read from its start. Offsets cost the driver a listing and two reads of EDGE bytes
for each file that changed; lines are read by the tasks, in ranges of ``splitBytes``.

A line belongs to the range that holds its end, a line feed or a carriage return. The reader of a range looks back to where its first line begins, so nothing of a line whose end is
not there yet has to be kept, and it comes whole with a later batch. Empty lines are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from methlake.sources.files import filesystem, listed

SCHEMA = "file string, place long, line string"
EDGE, SPLIT, STEP = 1024, 64 << 20, 1 << 20
_END = re.compile(rb"[\r\n]")


def _digest(fs: pafs.FileSystem, path: str, begin: int, end: int) -> str:
    with fs.open_input_file(path) as f:
        return hashlib.sha256(f.read_at(end - begin, begin)).hexdigest()[:16]


def _inode(fs: pafs.FileSystem, path: str) -> str:
    if isinstance(fs, pafs.LocalFileSystem):
        s = os.stat(path)
        return f"{s.st_dev}:{s.st_ino}"
    return ""


def mark(fs: pafs.FileSystem, path: str, size: int) -> list:
    """Size of a file and who it is up to that size."""
    return [size, _inode(fs, path), _digest(fs, path, 0, min(size, EDGE)), _digest(fs, path, max(0, size - EDGE), size)]


def same(fs: pafs.FileSystem, path: str, old: list, new: list) -> bool:
    """Whether the file of the new mark begins with all that the file of the old one had."""
    if new[0] < old[0] or new[1] != old[1]:
        return False
    try:
        return mark(fs, path, old[0])[2:] == old[2:]
    except OSError:
        return False


def lines(fs: pafs.FileSystem, path: str, begin: int, end: int, step: int = STEP) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines whose end is in [begin, end). A file that has become shorter since has what is left."""
    with fs.open_input_file(path) as f:
        end = min(end, f.size())
        # back to the end of the line before
        start = begin
        while start > 0:
            low = max(0, start - step)
            ends = [m.end() for m in _END.finditer(f.read_at(start - low, low))]
            if ends:
                start = low + ends[-1]
                break
            start = low
        held, at, first = [], start, start
        while at < end:
            chunk = f.read_at(min(step, end - at), at)
            if not chunk:
                return
            done = 0
            for m in _END.finditer(chunk):
                text = b"".join(held) + chunk[done : m.start()]
                if text:
                    yield first, text
                held, done = [], m.end()
                first = at + done
            held.append(chunk[done:])
            at += len(chunk)


class Range(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.pattern, self.split = options["path"], options.get("pattern", "*"), int(options.get("splitBytes", SPLIT))
        self.known: dict[str, tuple] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        fs, _ = filesystem(self.uri)
        found = {}
        for i in listed(self.uri, self.pattern):
            seen = (i.size, i.mtime_ns)
            if self.known.get(i.path, (None,))[0] != seen:
                try:
                    self.known[i.path] = (seen, mark(fs, i.path, i.size))
                except FileNotFoundError:
                    continue
            found[i.path] = self.known[i.path][1]
        return found

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        fs, _ = filesystem(self.uri)
        found = []
        for path, new in sorted(end.items()):
            old = start.get(path)
            if old == new:
                continue
            begin = old[0] if old is not None and same(fs, path, old, new) else 0
            found += [Range(path, b, min(new[0], b + self.split)) for b in range(begin, new[0], self.split)]
        return found or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = filesystem(self.uri)
        places, texts, held = [], [], 0
        try:
            for place, text in lines(fs, partition.path, partition.begin, partition.end):
                places.append(place)
                texts.append(text.decode("utf-8", "replace"))
                held += len(text)
                if held > STEP:
                    yield _batch(partition.path, places, texts)
                    places, texts, held = [], [], 0
        except FileNotFoundError:
            pass  # taken away since the offset was made
        if places:
            yield _batch(partition.path, places, texts)


def _batch(path: str, places: list[int], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.string())], ["file", "place", "line"])


class LogSource(DataSource):
    """Options: path (a folder or file), pattern (of file names), splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "logs"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def follow(spark: SparkSession, path: str, pattern: str = "*", split: int = SPLIT) -> DataFrame:
    """file, place (byte at which it starts), line of the log files under a path, as a stream."""
    spark.dataSource.register(LogSource)
    return spark.readStream.format("logs").option("pattern", pattern).option("splitBytes", split).load(path)
