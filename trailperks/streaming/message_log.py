"""A log of change messages in files, as a streaming source with positions.

The log is a folder of segments, read in the order of their names. A segment is a file of JSON lines, or a folder of such
files that Spark has written, which counts from its ``_SUCCESS`` file on. Segments are added behind the existing ones, and only
the last file may grow. A position is the file up to which the log was read and the number of bytes read of it, always at
the end of a line, so a line that is still being written is left for the next batch.

Options: ``path``; ``start``, ``earliest`` or ``latest``; ``startFile``, where the first position is kept, so that a query that
fails before its first commit starts at the same place again (needed for ``latest``); ``messagesPerBatch``, the
most messages of a batch. Files are read through Arrow's file systems (local, hdfs, s3, gs).

A line that is not a message of the right types gives a row with the line as ``value`` and no place, which the parser sets aside.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.json as pj
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from trailperks import schemas

NAME = "message_log"
MESSAGE = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])
#: Bytes that one task reads, and that are looked at together for the end of a line.
TASK_BYTES, BLOCK = 32 * 2**20, 2**16


@dataclass
class Piece(InputPartition):
    """The lines that begin in a range of bytes of a file, of which whole lines up to ``limit`` belong to the batch."""

    path: str
    low: int
    begin: int
    end: int
    limit: int


@dataclass(frozen=True)
class Segment:
    name: str
    path: str
    size: int


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def segments(system: fs.FileSystem, folder: str) -> list[Segment]:
    """All complete files of the log in the order of their names."""
    found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    below = {info.path[len(folder.rstrip("/")) + 1 :]: info for info in found}
    files = []
    for name, info in below.items():
        folder_name, _, base = name.rpartition("/")
        hidden = any(part[:1] in "_." for part in name.split("/"))
        if info.type == fs.FileType.File and not hidden and (not folder_name or f"{folder_name}/_SUCCESS" in below):
            files.append(Segment(name, info.path, info.size))
    return sorted(files, key=lambda segment: segment.name)


def line_end(handle, begin: int, limit: int) -> int:
    """The end of the last complete line in a range of bytes; ``begin`` if there is none."""
    while limit > begin:
        low = max(begin, limit - BLOCK)
        handle.seek(low)
        at = handle.read(limit - low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        limit = low
    return begin


def next_line(handle, at: int, limit: int) -> int:
    """The first place behind a line end at ``at`` or later, ``limit`` at most."""
    handle.seek(at)
    while at < limit:
        found = (block := handle.read(min(BLOCK, limit - at))).find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return limit


def after_lines(handle, begin: int, limit: int, count: int) -> tuple[int, int]:
    """The end of the ``count``-th line from ``begin`` on, and how many lines there are up to it."""
    handle.seek(begin)
    end, lines, at = begin, 0, begin
    while lines < count and at < limit:
        block = handle.read(min(BLOCK, limit - at))
        if not block:
            break
        inside = min(block.count(b"\n"), count - lines)
        if inside:
            lines, end = lines + inside, at + behind_lines(block, inside)
        at += len(block)
    return end, lines


def behind_lines(block: bytes, count: int) -> int:
    """The place behind the ``count``-th line end of a block that has as many, counted by halves without a step per line."""
    begin, end = 0, len(block)
    while end - begin > 1:
        middle = (begin + end) // 2
        inside = block.count(b"\n", begin, middle)
        if inside >= count:
            end = middle
        else:
            begin, count = middle, count - inside
    return end


def messages(data: bytes) -> pa.RecordBatch | None:
    """The messages of whole lines."""
    if not data.strip():
        return None
    try:
        options = pj.ParseOptions(explicit_schema=MESSAGE, unexpected_field_behavior="ignore")
        blocks = pj.ReadOptions(use_threads=False, block_size=len(data) + 1)
        return pj.read_json(io.BytesIO(data), blocks, options).select(MESSAGE.names).combine_chunks().to_batches()[0]
    except pa.ArrowInvalid:
        rows = [message(line) for line in data.decode("utf-8", "replace").split("\n") if line.strip()]
        return pa.RecordBatch.from_pylist(rows, MESSAGE)


def message(line: str) -> dict[str, object]:
    try:
        found = json.loads(line)
        return pa.RecordBatch.from_pylist([{name: found.get(name) for name in MESSAGE.names}], MESSAGE).to_pylist()[0]
    except (ValueError, AttributeError, pa.ArrowException):
        return {"partition": None, "offset": None, "value": line}


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return schemas.CHANGE_MESSAGE

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LogReader(dict(self.options))


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.latest = options.get("start", "earliest") == "latest"
        self.start_file = options.get("startfile")
        self.most = int(options.get("messagesperbatch") or 0)
        self.position: dict | None = None
        if self.latest and not self.start_file:
            raise ValueError("a start at the latest message needs startFile")

    def initialOffset(self) -> dict:
        found = self.kept_start()
        if found is None:
            found = self.newest() if self.latest else {"file": "", "bytes": 0}
            self.keep_start(found)
        self.position = found
        return found

    def latestOffset(self) -> dict:
        """The newest position, or that of as many messages as a batch may have."""
        return self.newest() if not self.most else self.some_further()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # Also called, with an empty range, when a query goes on: then it tells where.
        self.position = end
        system, folder = opened(self.uri)
        pieces = []
        for segment in segments(system, folder):
            if not start["file"] <= segment.name <= end["file"]:
                continue
            low = start["bytes"] if segment.name == start["file"] else 0
            high = end["bytes"] if segment.name == end["file"] else segment.size
            for begin in range(low, high, TASK_BYTES):
                pieces.append(Piece(segment.path, low, begin, min(begin + TASK_BYTES, high), high))
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.uri)
        with system.open_input_file(partition.path) as handle:
            begin, end = (
                at if at in (partition.low, partition.limit) else next_line(handle, at - 1, partition.limit)
                for at in (partition.begin, partition.end)
            )
            handle.seek(begin)
            found = messages(handle.read(end - begin))
        if found is not None and found.num_rows:
            yield found

    def newest(self) -> dict:
        system, folder = opened(self.uri)
        found = segments(system, folder)
        if not found:
            return self.position or {"file": "", "bytes": 0}
        last = found[-1]
        with system.open_input_file(last.path) as handle:
            return {"file": last.name, "bytes": line_end(handle, 0, last.size)}

    def some_further(self) -> dict:
        # A query that goes on has told its position before; a new one may ask for its first end before its start.
        position, left = self.position or self.initialOffset(), self.most
        system, folder = opened(self.uri)
        for segment in segments(system, folder):
            if segment.name < position["file"]:
                continue
            begin = position["bytes"] if segment.name == position["file"] else 0
            if begin < segment.size:
                with system.open_input_file(segment.path) as handle:
                    end, lines = after_lines(handle, begin, segment.size, left)
                position, left = {"file": segment.name, "bytes": end}, left - lines
            if not left:
                break
        return position

    def kept_start(self) -> dict | None:
        if not self.start_file:
            return None
        system, path = opened(self.start_file)
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_file(path) as handle:
            return json.loads(handle.read())

    def keep_start(self, position: dict) -> None:
        if self.start_file:
            system, path = opened(self.start_file)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(path) as handle:
                handle.write(json.dumps(position).encode())
