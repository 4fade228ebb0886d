"""Files that grow: one ``<i>.txt`` per instance, read on from a byte offset."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

BLOCK = 1 << 16


class TailSource(DataSource):
    """``format("weir_tail")`` with option ``path``: a folder all tasks can read, on any
    file system that Arrow knows (a path, or a ``file:``, ``hdfs:``, ``s3:``, ``gs:`` URI).

    Emits ``"<i>:<line>"``. Offsets are planned per batch, at line ends, and kept in
    the checkpoint: a replayed batch reads exactly the same bytes, and an unfinished
    last line waits for its end. Text is UTF-8. New bytes of a file are read by one
    task per ``split_bytes``; a line belongs to the split it starts in.

    ``max_bytes`` bounds a micro-batch: files that have grown share it evenly, what one
    leaves goes to the others, and only a single line may take a file beyond its share.
    Planning lists the folder and reads a block of each file that has grown. A plan goes
    on from the last one, which is kept in the file ``progress`` beside the checkpoint,
    as Spark does not tell a source where a restarted query stands. So ``max_bytes``
    needs ``progress``, from the first start of a query on.
    """

    @classmethod
    def name(cls) -> str:
        return "weir_tail"

    def schema(self) -> str:
        return "value STRING"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        limit = self.options.get("max_bytes")
        if limit is not None and not self.options.get("progress"):
            raise ValueError("max_bytes needs a file for progress")
        return _TailReader(
            self.options["path"],
            int(self.options.get("split_bytes", 1 << 26)),
            None if limit is None else int(limit),
            self.options.get("progress"),
        )


class _Split(InputPartition):
    def __init__(self, instance: str, start: int, end: int, at_line_start: bool):
        self.instance, self.start, self.end = instance, start, end
        self.at_line_start = at_line_start


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


class _TailReader(DataSourceStreamReader):
    def __init__(self, path: str, split_bytes: int, max_bytes: int | None = None, progress: str | None = None):
        self.path, self.split_bytes = path, split_bytes
        self.max_bytes, self.progress = max_bytes, progress
        self.planned: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        files, sizes = self._sizes()
        if self.max_bytes is None:
            return {i: self._last_line_end(files, i, 0, size) for i, size in sizes.items()}
        ends = self._shared_out(files, self._planned(), sizes)
        self._plan(ends)
        return ends

    def _shared_out(self, files: fs.FileSystem, before: dict[str, int], sizes: dict[str, int]) -> dict[str, int]:
        """Offsets that are at most ``max_bytes`` further on in all; files with least to
        read come first, and what they leave is shared by the rest."""
        ends = {i: min(before.get(i, 0), size) for i, size in sizes.items()}
        grown = sorted((size - ends[i], i) for i, size in sizes.items() if size > ends[i])
        left = self.max_bytes
        for n, (more, i) in enumerate(grown):
            start, share = ends[i], max(0, left) // (len(grown) - n)
            end = self._last_line_end(files, i, start, start + min(more, share))
            if end == start and share and more > share:  # a line longer than the share
                end = self._next_line_end(files, i, start + share, sizes[i]) or start
            ends[i] = end
            left -= end - start
        return ends

    def _sizes(self) -> tuple[fs.FileSystem, dict[str, int]]:
        files, folder = _located(self.path)
        sizes = {}
        for info in files.get_file_info(fs.FileSelector(folder)):
            instance, extension = posixpath.splitext(info.base_name)
            if extension == ".txt" and instance.isdigit() and info.is_file:
                sizes[instance] = info.size
        return files, dict(sorted(sizes.items()))

    def _planned(self) -> dict[str, int]:
        if self.planned is None:
            files, path = _located(self.progress)
            self.planned = {}
            if files.get_file_info(path).is_file:
                with files.open_input_file(path) as file:
                    self.planned = json.loads(file.read())
        return self.planned

    def _plan(self, ends: dict[str, int]) -> None:
        if ends != self.planned:
            files, path = _located(self.progress)
            with files.open_output_stream(path + ".new") as file:
                file.write(json.dumps(ends).encode())
            files.move(path + ".new", path)
        self.planned = ends

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        splits = []
        for instance in sorted(end):
            first = start.get(instance, 0)
            if end[instance] < first:
                raise ValueError(f"the plan of {instance}.txt ends before the checkpoint: was progress lost?")
            for at in range(first, end[instance], self.split_bytes):
                stop = min(at + self.split_bytes, end[instance])
                splits.append(_Split(instance, at, stop, at == first))
        return splits

    def read(self, partition: _Split) -> Iterator[tuple]:
        files, folder = _located(self.path)
        with files.open_input_file(f"{folder}/{partition.instance}.txt") as raw:
            lines = _Lines(raw)
            at = partition.start
            if not partition.at_line_start:
                at = at - 1 + len(lines.read_from(at - 1))
            while at < partition.end:
                line = lines.read_from(at)
                if not line:
                    return
                at += len(line)
                text = line.decode("utf-8").rstrip("\r\n")
                yield (f"{partition.instance}:{text}",)

    def _file(self, instance: str) -> str:
        return f"{_located(self.path)[1]}/{instance}.txt"

    def _last_line_end(self, files: fs.FileSystem, instance: str, start: int, end: int) -> int:
        """The last line end in these bytes; ``start`` without one."""
        if end <= start:
            return end
        with files.open_input_file(self._file(instance)) as file:
            while end > start:
                begin = max(start, end - BLOCK)
                cut = file.read_at(end - begin, begin).rfind(b"\n")
                if cut >= 0:
                    return begin + cut + 1
                end = begin
        return start

    def _next_line_end(self, files: fs.FileSystem, instance: str, start: int, end: int) -> int | None:
        with files.open_input_file(self._file(instance)) as file:
            while start < end:
                part = file.read_at(min(BLOCK, end - start), start)
                cut = part.find(b"\n")
                if cut >= 0:
                    return start + cut + 1
                start += len(part)
        return None


class _Lines:
    """Lines at rising byte places of a file, from a buffer of blocks."""

    def __init__(self, file):
        self.file, self.start, self.held = file, 0, b""

    def read_from(self, at: int) -> bytes:
        if not self.start <= at <= self.start + len(self.held):
            self.start, self.held = at, b""
        offset, parts = at - self.start, []
        while True:
            cut = self.held.find(b"\n", offset)
            if cut >= 0:
                return b"".join([*parts, self.held[offset : cut + 1]])
            parts.append(self.held[offset:])
            self.start += len(self.held)
            self.held, offset = self.file.read_at(BLOCK, self.start), 0
            if not self.held:
                return b"".join(parts)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TailSource)
