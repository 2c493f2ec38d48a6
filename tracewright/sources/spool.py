"""A perpetual tail over a tree of NDJSON files, as a streaming data source with byte offsets.

``spark.readStream.format("spool").option("path", ROOT).option("patterns", "*.ndjson").load()`` gives (rel_path,
byte_offset, raw, bytes, line_state).  An offset is a map from file to byte; a batch covers whole lines only, so a tail
without line end waits until it is complete.  Blank lines are skipped, lines over ``max_bytes`` give a row without text
and are passed over without being held, a file that shrank is read from its start, files are split over tasks
(``split_bytes`` each; a task reads the lines that begin in its range).

Admission.  ``trigger_bytes`` and ``trigger_lines`` bound what one batch takes: files in string order, whole lines, at least
one; the next batch goes on from there.  They are for running triggers, as ``availableNow`` ends with the first batch.  On
restart the bound counts from the offset noted in the file ``progress`` (one that all drivers see), without it the first
batch takes all there is.  ``excluded`` names a path part whose files are passed over, ``listing_seconds`` how long a
listing is used again.
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tracewright.sources import documents
from tracewright.sources.documents import read_state, write_state

SCHEMA = "rel_path string, byte_offset bigint, raw string, bytes bigint, line_state string"
CHUNK = 1 << 20


class FileRange(InputPartition):
    """Bytes of a file; ``whole`` if a line begins at its start, otherwise the first line that begins in it is the first."""

    def __init__(self, root: str, rel: str, start: int, end: int, whole: bool = True):
        super().__init__((root, rel, start, end, whole))
        self.root, self.rel, self.start, self.end, self.whole = root, rel, start, end, whole


def listing(root: str, patterns: list[str], excluded: str | None = None) -> dict[str, int]:
    """Sizes of the matching files by their path below the root, in string order."""
    found = {}
    for folder, inner, names in os.walk(root):
        inner[:] = [f for f in inner if f != excluded]
        for name in names:
            if name != excluded and any(name.endswith(p[1:]) if p.startswith("*") else name == p for p in patterns):
                path = os.path.join(folder, name)
                found[os.path.relpath(path, root)] = os.path.getsize(path)
    return dict(sorted(found.items()))


def admitted(path: str, start: int, end: int, most_bytes: int, most_lines: int) -> tuple[int, int]:
    """(the place up to which lines are taken, how many): whole lines within both bounds, but at least the first."""
    at, lines = start, 0
    with open(path, "rb") as f:
        f.seek(start)
        while at < end and lines < most_lines:
            size = 0
            while (piece := f.readline(CHUNK)) and not piece.endswith(b"\n"):
                size += len(piece)
            size += len(piece)
            if not piece or lines and at + size - start > most_bytes:
                break
            at, lines = at + size, lines + 1
    return at, lines


def complete_until(path: str, start: int, end: int) -> int:
    """The place after the last line end in [start, end); ``start`` if there is none."""
    with open(path, "rb") as f:
        at = end
        while at > start:
            begin = max(start, at - CHUNK)
            f.seek(begin)
            place = f.read(at - begin).rfind(b"\n")
            if place >= 0:
                return begin + place + 1
            at = begin
    return start


def lines_of(part: FileRange, most: int) -> Iterator[tuple]:
    """The lines of a range; one that is too long is skimmed in chunks."""
    with open(os.path.join(part.root, part.rel), "rb") as f:
        at = part.start
        if not part.whole:  # the line that reaches in from the range before is that one's
            f.seek(at - 1)
            while (piece := f.readline(CHUNK)) and not piece.endswith(b"\n"):
                pass
            at = f.tell()
        f.seek(at)
        while at < part.end:
            line = f.readline(most + 1)
            size = len(line)
            if not line.endswith(b"\n") and size > most:
                while line and not line.endswith(b"\n"):
                    line = f.readline(CHUNK)
                    size += len(line)
                yield part.rel, at, None, size, "oversize"
            elif line.strip():
                yield part.rel, at, line.rstrip(b"\r\n").decode("utf-8", "replace"), size, "complete"
            if not size:
                return
            at += size


class _Options:
    def __init__(self, options: dict):
        self.root = options["path"]
        self.patterns = options.get("patterns", "*.ndjson").split(",")
        self.excluded = options.get("excluded")
        self.most = int(options.get("max_bytes", 8 << 20))
        self.split = int(options.get("split_bytes", 64 << 20))
        self.trigger_bytes = int(options.get("trigger_bytes", 0))
        self.trigger_lines = int(options.get("trigger_lines", 0))
        self.progress = options.get("progress")
        self.keep = float(options.get("listing_seconds", 0))
        self._listed: tuple[float, dict[str, int]] = (0.0, {})

    def files(self) -> dict[str, int]:
        when, found = self._listed
        if not found or time.monotonic() - when >= self.keep:
            found = listing(self.root, self.patterns, self.excluded)
            self._listed = (time.monotonic(), found)
        return found

    def ranges(self, rel: str, start: int, end: int) -> list[FileRange]:
        return [FileRange(self.root, rel, at, min(at + self.split, end), at == start) for at in range(start, end, self.split)]


class SpoolReader(_Options, DataSourceReader):
    def partitions(self) -> list[FileRange]:
        return [r for rel, size in self.files().items() for r in self.ranges(rel, 0, complete_until(os.path.join(self.root, rel), 0, size))]

    def read(self, partition: FileRange) -> Iterator[tuple]:
        return lines_of(partition, self.most)


class SpoolStreamReader(_Options, DataSourceStreamReader):
    def __init__(self, options: dict):
        super().__init__(options)
        noted = read_state(self.progress, {}) if self.progress else {}
        self.taken: dict[str, int] | None = noted or None  # offset of the last planned batch, if it is known

    def initialOffset(self) -> dict:
        self.taken = {}
        return {}

    def latestOffset(self) -> dict:
        bounded = self.taken is not None and (self.trigger_bytes or self.trigger_lines)
        room, lines = self.trigger_bytes or 1 << 62, self.trigger_lines or 1 << 62
        end = dict(self.taken or {}) if bounded else {}
        took = False
        for rel, size in self.files().items():
            path = os.path.join(self.root, rel)
            if not bounded:
                end[rel] = complete_until(path, 0, size)
                continue
            start = end.get(rel, 0) if end.get(rel, 0) <= size else 0
            to = complete_until(path, start, size)
            if to <= start or took and (room <= 0 or lines <= 0):
                continue
            at, n = admitted(path, start, to, room, lines)
            if took and at - start > room:
                break
            end[rel], room, lines, took = at, room - (at - start), lines - n, True
        if bounded:
            self._note(end)
        return end

    def _note(self, offset: dict) -> None:
        self.taken = offset
        if self.progress:
            write_state(self.progress, offset)

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        if self.taken is None:
            self._note(end)
        out = []
        for rel, to in end.items():
            begin = start.get(rel, 0)
            begin = 0 if begin > to else begin  # the file was cut and begun anew
            out += self.ranges(rel, begin, to)
        return out

    def read(self, partition: FileRange) -> Iterator[tuple]:
        return lines_of(partition, self.most)

    def commit(self, end: dict) -> None:
        """The checkpoint keeps the offsets; nothing is deleted here."""


class SpoolSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "spool"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SpoolReader:
        return SpoolReader(self.options)

    def streamReader(self, schema) -> SpoolStreamReader:
        return SpoolStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format ``spool`` known to a session. What plans a stream runs in a process of its own that knows no files
    added to the session, so the source is sent there with its code."""
    for module in (sys.modules[__name__], documents):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(SpoolSource)


#: Adapters a stream may name; the broker ones need their connector on the class path.
ADAPTERS = {"dir-spool": "spool", "kafka": "kafka"}


def adapter(name: str) -> str:
    """The Spark format of an adapter; unknown ones are refused."""
    if name not in ADAPTERS:
        raise ValueError(f"no such adapter: {name}; known are {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name]
