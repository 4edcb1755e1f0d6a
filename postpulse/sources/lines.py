"""A live source of raw lines: a folder that collectors keep adding files to.

A source of Spark's ``DataSource`` API. Files become part of the stream in the
order in which the reader first sees them; it writes that order down, in
numbered files beside the query's checkpoint, and an offset is a number of
files. A micro-batch takes files up to a number or a size of its own choosing
(admission), so a long folder is read in steps of bounded size, and a query that
starts again goes on behind the last micro-batch it has planned. Large files are
split at line ends into partitions that are read side by side.

The source's own filter is pushed to the readers: with ``langs`` a line that
begins like a post and surely has none of these languages is never handed to
Spark. (``raw.select_posts`` decides; this only spares it lines.) Notices and
all other lines pass.

Files don't change once they can be seen: collectors write them elsewhere, or
under a name that begins with a dot or an underscore, and rename them. A file
that is gone when its turn comes fails the query. A line ends with \\n or \\r\\n;
bytes that are no UTF-8 become the replacement character, as in Spark.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .raw import POST_PREFIX

# The source travels to the executors whole: no package to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Of a micro-batch, and of a partition. A file larger than that is a
#: micro-batch of its own.
BATCH_BYTES, BATCH_FILES, SPLIT_BYTES = 1 << 30, 10_000, 64 << 20
#: Bytes read at once, and lines handed on at once.
CHUNK, LINES = 4 << 20, 10_000
_LANG = re.compile(rb'"lang"\s*:\s*"([^"]*)"')


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a URI or a local path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@dataclass
class Part(InputPartition):
    """The lines of a file that begin from start to before end."""

    path: str
    start: int
    end: int


class Order:
    """The files in the order in which they were first seen: one JSON line for
    each, in numbered files that are written once."""

    def __init__(self, folder: str) -> None:
        self.system, self.path = opened(folder)
        self.files: list[tuple[str, int]] = []
        self.known: set[str] = set()
        self.parts = 0
        self._load()

    def _load(self) -> None:
        self.system.create_dir(self.path, recursive=True)
        names = {info.base_name for info in self.system.get_file_info(fs.FileSelector(self.path))}
        while f"{self.parts:010d}.jsonl" in names:
            with self.system.open_input_stream(f"{self.path}/{self.parts:010d}.jsonl") as source:
                for line in source.read().splitlines():
                    name, size = json.loads(line)
                    self.files.append((name, size))
                    self.known.add(name)
            self.parts += 1

    def add(self, found: list[tuple[str, int]]) -> None:
        new = sorted(entry for entry in found if entry[0] not in self.known)
        if not new:
            return
        self._write(f"{self.parts:010d}.jsonl", "\n".join(map(json.dumps, new)))
        self.parts += 1
        self.files += new
        self.known.update(name for name, _ in new)

    def planned(self) -> int:
        """How many files the micro-batches planned so far have taken."""
        info = self.system.get_file_info(f"{self.path}/planned")
        if info.type == fs.FileType.NotFound:
            return 0
        with self.system.open_input_stream(info.path) as source:
            return int(source.read())

    def plan(self, files: int) -> None:
        self._write("planned", str(files))

    def _write(self, name: str, text: str) -> None:
        with self.system.open_output_stream(f"{self.path}/.{name}") as out:
            out.write(text.encode())
        self.system.move(f"{self.path}/.{name}", f"{self.path}/{name}")


class LineReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"].rstrip("/")
        self.order_path = options["order"].rstrip("/")
        self.batch_bytes = int(options.get("batchbytes", BATCH_BYTES))
        self.batch_files = int(options.get("batchfiles", BATCH_FILES))
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        langs = [lang.strip() for lang in options.get("langs", "").split(",") if lang.strip()]
        self.langs = frozenset(lang.encode() for lang in langs)
        self._order: Order | None = None
        self._at = 0

    def __getstate__(self) -> dict:
        # Tasks read parts, and need no order.
        return {**self.__dict__, "_order": None}

    @property
    def order(self) -> Order:
        if self._order is None:
            self._order = Order(self.order_path)
            self._at = self._order.planned()
        return self._order

    def _listed(self) -> list[tuple[str, int]]:
        system, path = opened(self.folder)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return [
            (info.base_name, info.size)
            for info in found
            if info.type == fs.FileType.File and info.size and info.base_name[0] not in "._"
        ]

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        """The end of the next micro-batch: behind the last planned one, as many
        files as are admitted."""
        order = self.order
        order.add(self._listed())
        end, size = self._at, 0
        while end < len(order.files) and end - self._at < self.batch_files:
            size += order.files[end][1]
            if end > self._at and size > self.batch_bytes:
                break
            end += 1
        return {"files": end}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        order = self.order
        # Written before any task runs: a query that starts again repeats this
        # micro-batch by its own log, and admits what comes behind it.
        if end["files"] > self._at:
            self._at = end["files"]
            order.plan(self._at)
        return [
            Part(f"{self.folder}/{name}", lo, min(lo + self.split_bytes, size))
            for name, size in order.files[start["files"] : end["files"]]
            for lo in range(0, size, self.split_bytes)
        ]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []
        for line in _lines(partition):
            if self._wanted(line):
                lines.append(line.decode("utf-8", "replace"))
                if len(lines) == LINES:
                    yield _batch(lines)
                    lines = []
        if lines:
            yield _batch(lines)

    def _wanted(self, line: bytes) -> bool:
        if not self.langs or not line.startswith(POST_PREFIX.encode()):
            return True
        found = _LANG.findall(line)
        # A language that is written with escapes is left to the decoder.
        return any(lang in self.langs or b"\\" in lang for lang in found)

    def commit(self, end: dict) -> None:
        pass


def _lines(part: Part) -> Iterator[bytes]:
    system, path = opened(part.path)
    with system.open_input_file(path) as source:
        # A line belongs to the part that it begins in; the byte before the
        # part tells whether one begins at its start.
        at = max(part.start - 1, 0)
        source.seek(at)
        skipping, rest = part.start > 0, b""
        while True:
            chunk = source.read(CHUNK)
            if not chunk:
                break
            pieces = (rest + chunk).split(b"\n")
            rest = pieces.pop()
            for piece in pieces:
                begun = at
                at += len(piece) + 1
                if skipping:
                    skipping = False
                elif begun < part.end:
                    yield piece.removesuffix(b"\r")
                if at >= part.end:
                    return
        if rest and not skipping and at < part.end:
            yield rest.removesuffix(b"\r")


def _batch(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


class LineSource(DataSource):
    """``format("postpulse_lines")``. Options: path, order (a folder that
    belongs to one query, beside its checkpoint), batchBytes, batchFiles,
    splitBytes, langs."""

    @classmethod
    def name(cls) -> str:
        return "postpulse_lines"

    def schema(self) -> str:
        return "value STRING"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LineReader({key.lower(): value for key, value in self.options.items()})


def stream_folder(spark: SparkSession, path: str, order: str, **options: str | int) -> DataFrame:
    """Endless scan of a folder of lines; ``order`` names a folder beside the
    query's checkpoint, of that query alone. (A run that drains what is there,
    ``availableNow``, takes one micro-batch: run it until it finds nothing.)"""
    spark.dataSource.register(LineSource)
    reader = spark.readStream.format(LineSource.name()).option("path", path).option("order", order)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()
