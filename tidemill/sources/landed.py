"""A folder of line files as a message stream with a start position.

Files are ordered by (modification time, name); an offset is the last file read.
A stream starts at the earliest file, after the latest, at a time, or after a
stored offset, and files before the start are listed but never opened.  Later
starts go on from the checkpoint.  Tasks read one file each.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

Position = tuple[int, str]
#: Sorts after any name.
_LAST_NAME = "\U0010FFFF"
_LINES = 10_000


class LandedFile(InputPartition):
    def __init__(self, folder: str, micros: int, name: str):
        super().__init__((folder, micros, name))
        self.folder, self.micros, self.name = folder, micros, name


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def landed(folder: str) -> list[Position]:
    """Files of a folder, oldest first; hidden files, marks and subfolders do not count."""
    system, path = _open(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((f.mtime_ns // 1000, posixpath.basename(f.path)) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))


def start_of(start: str, files: list[Position]) -> Position:
    """The position before the first file to read: ``earliest``, ``latest``, an epoch-millisecond time, or a stored offset as JSON."""
    if start == "earliest":
        return -1, ""
    if start == "latest":
        return files[-1] if files else (-1, "")
    if start.lstrip("-").isdigit():
        return int(start) * 1000 - 1, _LAST_NAME
    try:
        kept = json.loads(start)
        return int(kept["micros"]), str(kept["name"])
    except (ValueError, KeyError, TypeError):
        raise ValueError(f"unknown start position: {start!r}") from None


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str, start: str):
        self.folder, self.start = folder, start

    @staticmethod
    def _offset(at: Position) -> dict:
        return {"micros": at[0], "name": at[1]}

    def initialOffset(self) -> dict:
        return self._offset(start_of(self.start, landed(self.folder)))

    def latestOffset(self) -> dict:
        files = landed(self.folder)
        first = start_of(self.start, files) if self.start not in ("earliest", "latest") else (-1, "")
        return self._offset(max([first, *files[-1:]]))

    def partitions(self, start: dict, end: dict) -> list[LandedFile]:
        low, high = (start["micros"], start["name"]), (end["micros"], end["name"])
        return [LandedFile(self.folder, *f) for f in landed(self.folder) if low < f <= high]

    def read(self, partition: LandedFile) -> Iterator[pa.RecordBatch]:
        system, path = _open(partition.folder)
        lines: list[str] = []

        def batch() -> pa.RecordBatch:
            n = len(lines)
            return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([partition.micros] * n, pa.timestamp("us", "UTC")),
                                               pa.array([partition.name] * n, pa.string())], ["value", "timestamp", "file"])

        with system.open_input_stream(posixpath.join(path, partition.name)) as raw:
            rest = b""
            while block := raw.read(1 << 20):
                *whole, rest = (rest + block).split(b"\n")
                lines += [line.decode("utf-8", "replace") for line in whole]
                if len(lines) >= _LINES:
                    yield batch()
                    lines.clear()
            if rest:
                lines.append(rest.decode("utf-8", "replace"))
        if lines:
            yield batch()


class LandedMessages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_messages"

    def schema(self) -> str:
        return "value string, timestamp timestamp, file string"

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("start", "earliest"))


def read_landed(spark: SparkSession, folder: str, start: str = "earliest") -> DataFrame:
    """Messages (value, timestamp, file) of the lines that land in a folder, from ``start`` on.

    ``timestamp`` is the file's modification time.  Files are whole when they
    appear, as after a rename.  A file that lands with an older time than one
    already read is not seen: the order of landing is the order of the stream.
    """
    start_of(start, [])
    spark.dataSource.register(LandedMessages)
    return spark.readStream.format("landed_messages").option("start", start).load(folder)
