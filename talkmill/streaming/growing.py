"""A streaming source over files of lines that grow: whole lines arrive once, with the numbers that they have in their file.

The offset is the end of the last whole line of each file, in bytes; a line that is still being written waits. New bytes are cut into splits
that tasks read for themselves, small files many to a task; a line belongs to the split in which it begins, and its number comes from
counting the line ends before it. Files that have changed are looked into by several threads.
A file that became shorter was replaced and is read from its start. Files are reached by ``pyarrow.fs``, so any store that it knows will do.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.semantics import trimmed
from ..sources.transcripts import source_meta

SPLIT_BYTES = 32 << 20
#: Files that one task reads, at most: each counts at least as so small a part of a split. Threads that look for ends of lines.
FILES, THREADS = 256, 16
_BLOCK = 1 << 20


class Splits(InputPartition):
    """What one task reads: (file, start, end, where the file's new bytes begin) of each piece."""

    def __init__(self, pieces: list[tuple[str, int, int, int]]):
        self.pieces = pieces


def packed(pieces: list[tuple[str, int, int, int]], split: int) -> list[Splits]:
    """Pieces of files put together, in order, up to about ``split`` bytes or FILES pieces a task."""
    out: list[list] = []
    room = 0.0
    for piece in pieces:
        cost = max(piece[2] - piece[1], split / FILES)
        if not out or cost > room:
            out.append([])
            room = float(split)
        out[-1].append(piece)
        room -= cost
    return [Splits(p) for p in out]


def end_of_lines(stream, size: int) -> int:
    """The end of the last whole line of a file's first ``size`` bytes."""
    end = size
    while end > 0:
        start = max(0, end - 65_536)
        stream.seek(start)
        at = stream.read(end - start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        end = start
    return 0


def lines_before(stream, end: int) -> int:
    stream.seek(0)
    n, at = 0, 0
    while at < end:
        block = stream.read(min(_BLOCK, end - at))
        if not block:
            break
        n, at = n + block.count(b"\n"), at + len(block)
    return n


def split_lines(stream, start: int, end: int, first: int) -> Iterator[tuple[int, bytes]]:
    """(number, line) of the lines that begin in [start, end); ``first`` is where the new bytes of the file begin, which is a line's start."""
    if start > first:  # the line that is under way belongs to the split before
        stream.seek(start - 1)
        at, found = start - 1, False
        while not found:
            block = stream.read(_BLOCK)
            if not block:
                return
            n = block.find(b"\n")
            at, found = (at + n + 1, True) if n >= 0 else (at + len(block), False)
        start = at
    if start >= end:
        return
    number = lines_before(stream, start)
    stream.seek(start)
    at, rest = start, b""
    while at < end:
        block = stream.read(_BLOCK)
        if not block:
            return
        *lines, rest = (rest + block).split(b"\n")
        for line in lines:
            if at >= end:
                return
            number += 1
            at += len(line) + 1
            yield number, line


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, path: str, suffix: str, split: int):
        self.store, self.root = fs.FileSystem.from_uri(path)
        self.path, self.suffix, self.split = path, suffix, split
        self._seen: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {"ends": "{}"}

    def latestOffset(self) -> dict:
        ends, changed = {}, []
        for info in self.store.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            name = info.path.rsplit("/", 1)[-1]
            if info.type != fs.FileType.File or not name.endswith(self.suffix) or name.startswith((".", "_")):
                continue
            size, end = self._seen.get(info.path, (-1, 0))
            if size != info.size:  # only files that have changed are looked into
                changed.append((info.path, info.size))
            ends[info.path] = end

        def look(path: str, size: int) -> int:
            with self.store.open_input_file(path) as stream:
                return end_of_lines(stream, size)

        with ThreadPoolExecutor(THREADS) as threads:
            for (path, size), end in zip(changed, threads.map(lambda f: look(*f), changed), strict=True):
                self._seen[path] = size, end
                ends[path] = end
        return {"ends": json.dumps(ends, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Splits]:
        before, out = json.loads(start["ends"]), []
        for file, last in json.loads(end["ends"]).items():
            first = before.get(file, 0)
            first = 0 if last < first else first
            out += [(file, a, min(a + self.split, last), first) for a in range(first, last, self.split)]
        return packed(out, self.split)

    def read(self, partition: Splits) -> Iterator[tuple]:
        for file, start, end, first in partition.pieces:
            with self.store.open_input_file(file) as stream:
                for number, line in split_lines(stream, start, end, first):
                    yield file, number, line.decode("utf-8", "replace")

    def __getstate__(self) -> dict:
        return {"path": self.path, "suffix": self.suffix, "split": self.split}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)


class GrowingLines(DataSource):
    """Options: path, suffix (.jsonl by default), splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "file string, line_no bigint, line string"

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(self.options["path"], self.options.get("suffix", ".jsonl"), int(self.options.get("splitBytes", SPLIT_BYTES)))


def growing_lines(spark: SparkSession, root: str, **options) -> DataFrame:
    """A stream of (file, line_no, line) as ``read_lines`` gives them in a batch: trimmed, without blank lines, which are counted."""
    spark.dataSource.register(GrowingLines)
    lines = spark.readStream.format("growing_lines").options(path=root, **options).load()
    return lines.withColumn("line", trimmed(F.col("line"))).where("line <> ''")


def growing_transcripts(spark: SparkSession, root: str, **options) -> DataFrame:
    """The same for transcript files, with source_type, session_id and session_key, as ``read_transcripts`` gives them."""
    named = growing_lines(spark, root, **options).withColumn("meta", source_meta(F.col("file")))
    return named.where("meta is not null").select("file", "line_no", "line", "meta.*")
