"""A streaming source over capture files: lines of ``topic<space>payload``, read as they are written, filtered by topic in the reader.

    spark.dataSource.register(CaptureSource)
    spark.readStream.format("capture").option("topics", "factory/+/oven-01/#").load(folder)

Files are taken in the order of their names; only the newest one grows. A position is therefore one file name and a byte
offset, however many files there are. A batch is cut into byte ranges that tasks read on their own; a line belongs to the range it
starts in, and a last line without its end waits for the rest of it. Positions are kept by the query's checkpoint, so a
restart reads a batch that was not committed again and nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "topic string, raw_payload string, file string, position bigint"
RANGE_BYTES = 8 << 20


def topic_pattern(filters: str) -> re.Pattern:
    """Comma-separated topic filters: ``+`` stands for one level, ``#`` at the end for the rest, the level above included."""
    found = []
    for one in filters.split(","):
        levels, rest = one.strip().split("/"), ""
        if levels[-1] == "#":
            levels, rest = levels[:-1], "(?:/.*)?" if len(levels) > 1 else ".*"
        if "#" in levels:
            raise ValueError(f"# may only be the last level: {one}")
        found.append("/".join("[^/]*" if level == "+" else re.escape(level) for level in levels) + rest)
    return re.compile("|".join(f"(?:{x})" for x in found), re.DOTALL)


@dataclass
class Range(InputPartition):
    """Bytes of one file; lines that start in them."""

    file: str
    start: int
    end: int


class CaptureReader:
    def __init__(self, options: dict):
        self.folder, self.range_bytes = options["path"], int(options.get("rangebytes", RANGE_BYTES))
        self.pattern = topic_pattern(options.get("topics", "#"))

    def files(self) -> list[tuple[str, int]]:
        system, path = fs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (
            fs.LocalFileSystem(), self.folder)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted((f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith((".", "_")))

    def open(self, name: str):
        system, path = fs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (
            fs.LocalFileSystem(), self.folder)
        return system.open_input_file(f"{path}/{name}")

    def ranges(self, name: str, start: int, end: int) -> list[Range]:
        return [Range(name, at, min(end, at + self.range_bytes)) for at in range(start, end, self.range_bytes)]

    def last_line_end(self, name: str, start: int, size: int) -> int:
        """Where the last finished line between ``start`` and ``size`` ends; ``start`` if there is none."""
        with self.open(name) as file:
            at = size
            while at > start:
                low = max(start, at - 65_536)
                file.seek(low)
                cut = file.read(at - low).rfind(b"\n")
                if cut >= 0:
                    return low + cut + 1
                at = low
        return start

    def read(self, part: Range) -> Iterator[tuple]:
        with self.open(part.file) as file:
            at = part.start
            if at:      # a line that starts before this range belongs to the one before
                file.seek(at - 1)
                rest = b""
                while b"\n" not in rest:
                    more = file.read(65_536)
                    if not more:
                        return
                    rest += more
                at += rest.index(b"\n")
            file.seek(at)
            held = b""
            while at < part.end:
                cut = held.find(b"\n")
                if cut < 0:
                    more = file.read(1 << 20)
                    if not more:
                        break
                    held += more
                    continue
                yield from self._row(held[:cut], part.file, at)
                held, at = held[cut + 1:], at + cut + 1
            if at < part.end and held:     # only batch readers get here: the last line of a file without its end
                yield from self._row(held, part.file, at)

    def _row(self, line: bytes, name: str, at: int) -> Iterator[tuple]:
        topic, blank, payload = line.decode("utf-8", "replace").strip().partition(" ")
        if blank and self.pattern.fullmatch(topic):
            yield topic, payload, name, at


class CaptureBatchReader(CaptureReader, DataSourceReader):
    def partitions(self) -> list[Range]:
        return [r for name, size in self.files() for r in self.ranges(name, 0, size)]


class CaptureStreamReader(CaptureReader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def latestOffset(self) -> dict:
        known = self.files()
        if not known:
            return self.initialOffset()
        name, size = known[-1]
        return {"file": name, "at": self.last_line_end(name, 0, size)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for name, size in self.files():
            if name < start["file"] or name > end["file"]:
                continue
            first = start["at"] if name == start["file"] else 0
            last = end["at"] if name == end["file"] else size
            out += self.ranges(name, first, last)
        return out

    def commit(self, end: dict) -> None:
        """Capture files stay."""


class CaptureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "capture"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return CaptureBatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return CaptureStreamReader(self.options)
