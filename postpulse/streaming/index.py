"""Index sink: documents with ids, sent in bulks, each there once.

A sink of Spark's ``DataSource`` API for batches and streams. Every row is a
document (index, id, value). A task sends its documents in bulks, flushed by
number or bytes; a bulk that fails is sent again after a growing pause. What a
task has sent becomes visible when the driver commits the micro-batch: the
commit names the files of the tasks that succeeded, under the micro-batch's
number. A second attempt of a task, a lost executor's files, or a micro-batch
that failed is never named, and a micro-batch that is replayed after its commit
is left as it is. Ids follow from index, window and key, so a document that is
sent twice, within a bulk that failed half-way, is one document to a reader,
and that of a later micro-batch replaces an earlier one.

The store is a folder that all executors and the driver reach, local or of any
file system that Arrow knows. ``Bulks`` is all that knows about it: another
class with its methods sends to another store.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyarrow import fs
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamWriter,
    DataSourceWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .documents import documents
from .sinks import Output
from .windows import state_settings

# The sink travels to the executors whole: no package to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "index STRING, id STRING, value STRING"
# A bulk's most documents, tries and the first pause in seconds.
BULK_DOCUMENTS, TRIES, PAUSE = 50, 6, 2.0
BULK_BYTES = 5 << 20
_COMMITS, _FILES = "commits", "files"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a URI or a local path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Bulks:
    """One task's file of the store. A bulk is one write; after one that fails
    the next goes to a new file, as the old one may end in half a line."""

    def __init__(self, root: str, name: str) -> None:
        self.root, self.name = root, name
        self.files: list[str] = []
        self._out = None

    def send(self, lines: list[str]) -> None:
        if self._out is None:
            system, path = opened(f"{self.root}/{_FILES}")
            system.create_dir(path, recursive=True)
            file = f"{self.name}-{len(self.files)}.jsonl"
            self._out = system.open_output_stream(f"{path}/{file}")
            self.files.append(file)
        self._out.write(("\n".join(lines) + "\n").encode())

    def failed(self) -> None:
        try:
            self.close()
        except OSError:
            pass
        self._out = None

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None


@dataclass
class Sent(WriterCommitMessage):
    files: list[str]
    documents: int
    bulks: int


class _Sending:
    """What batches and streams share: the sending tasks, and the commits."""

    transport = Bulks

    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].rstrip("/")
        self.most = int(options.get("bulkdocuments", BULK_DOCUMENTS))
        self.bytes = int(options.get("bulkbytes", BULK_BYTES))
        self.tries = int(options.get("tries", TRIES))
        self.pause = float(options.get("pause", PAUSE))

    def write(self, iterator: Iterator[Row]) -> Sent:
        target = self.transport(self.root, uuid.uuid4().hex)
        lines, size, documents, bulks = [], 0, 0, 0
        for row in iterator:
            line = json.dumps({"index": row["index"], "id": row["id"], "value": row["value"]})
            if lines and (len(lines) >= self.most or size + len(line) > self.bytes):
                self._flush(target, lines)
                bulks, lines, size = bulks + 1, [], 0
            lines.append(line)
            size += len(line)
            documents += 1
        if lines:
            self._flush(target, lines)
            bulks += 1
        target.close()
        return Sent(target.files, documents, bulks)

    def _flush(self, target: Bulks, lines: list[str]) -> None:
        for attempt in range(self.tries):
            try:
                target.send(lines)
                return
            except OSError:
                target.failed()
                if attempt + 1 == self.tries:
                    raise
                time.sleep(self.pause * 2**attempt)

    def _commit(self, name: str, messages: list[Sent | None]) -> None:
        """Names the files of a commit, unless it has been made before. The
        file gets its name when it is whole."""
        system, path = opened(f"{self.root}/{_COMMITS}")
        system.create_dir(path, recursive=True)
        if system.get_file_info(f"{path}/{name}.json").type != fs.FileType.NotFound:
            self._discard(messages)
            return
        files = [file for sent in messages if sent for file in sent.files]
        total = sum(sent.documents for sent in messages if sent)
        # One line a file: readers join them with the files' own names.
        lines = [json.dumps({"commit": name, "documents": total})]
        lines += [json.dumps({"commit": name, "file": file}) for file in files]
        unnamed = f"{path}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(unnamed) as out:
            out.write("\n".join(lines).encode())
        system.move(unnamed, f"{path}/{name}.json")

    def _discard(self, messages: list[Sent | None]) -> None:
        system, path = opened(f"{self.root}/{_FILES}")
        for sent in messages:
            for file in sent.files if sent else ():
                if system.get_file_info(f"{path}/{file}").type == fs.FileType.File:
                    system.delete_file(f"{path}/{file}")


class IndexBatchWriter(_Sending, DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        self.name = options.get("commit") or f"batch-{uuid.uuid4().hex}"

    def commit(self, messages: list[Sent | None]) -> None:
        self._commit(self.name, messages)

    def abort(self, messages: list[Sent | None]) -> None:
        self._discard(messages)


class IndexStreamWriter(_Sending, DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        self.query = options.get("query", "stream")

    def commit(self, messages: list[Sent | None], batchId: int) -> None:
        self._commit(f"{self.query}-{batchId:010d}", messages)

    def abort(self, messages: list[Sent | None], batchId: int) -> None:
        self._discard(messages)


class IndexSink(DataSource):
    """``format("postpulse_index")``. Options: path, bulkDocuments, bulkBytes,
    tries, pause (seconds, doubled after each try); for a stream, query: a name
    of its own among those that write to the path; for a batch, commit: a name
    under which it is written once."""

    @classmethod
    def name(cls) -> str:
        return "postpulse_index"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict[str, str]:
        return {key.lower(): value for key, value in self.options.items()}

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return IndexBatchWriter(self._options())

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return IndexStreamWriter(self._options())


def index_rows(rows: DataFrame, metric: str, index: str) -> DataFrame:
    """A metric's rows as documents with ids. The id is a digest of the index,
    the window and the keys: all columns but the measures."""
    keys = [name for name in rows.columns if name in ("topic", "tweet_type", "hashtag", "word", "source", "sentiment")]
    at = [F.unix_millis("window_start")] if "window_start" in rows.columns else []
    name = F.sha2(F.concat(*map(_key, [F.lit(index), *at, *map(F.col, keys)])), 256)
    return documents(rows, metric, F.lit(index).alias("index"), name.alias("id"))


def _key(part: Column) -> Column:
    """Null and lengths are told, so that different keys never read alike."""
    text = part.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def start_index(
    rows: DataFrame,
    name: str,
    root: str,
    checkpoint: str,
    trigger: str | None = None,
    partitions: int | None = None,
    sink: type[IndexSink] = IndexSink,
    **options: str,
) -> StreamingQuery:
    """Sends a stream's documents (``index_rows``) to the store under ``root``."""
    rows.sparkSession.dataSource.register(sink)
    writer = (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .format(sink.name())
        .option("path", root)
        .option("query", name)
        .option("checkpointLocation", f"{checkpoint}/{name}")
    )
    for key, value in options.items():
        writer = writer.option(key, value)
    with state_settings(rows.sparkSession, partitions):
        if trigger is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=trigger).start()


def write_bulks(root: str, query: str, outputs: list[Output]) -> Callable[[DataFrame, int], None]:
    """Batch writer for ``foreachBatch``: the documents of several metrics that
    follow from one batch, as one commit of the micro-batch's number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.dataSource.register(IndexSink)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            made = [index_rows(derive(batch), metric, index) for metric, index, derive in outputs]
            rows = reduce(DataFrame.unionByName, made)
            writer = rows.write.format(IndexSink.name()).mode("append").option("path", root)
            writer.option("commit", f"{query}-{batch_id:010d}").save()
        finally:
            batch.unpersist()

    return write


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """(index, id, value): the committed documents, each id once, as the last
    commit has it. Files that no commit names are not seen."""
    system, path = opened(f"{root}/{_COMMITS}")
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return spark.createDataFrame([], SCHEMA)
    named = (
        spark.read.schema("commit STRING, file STRING").json(f"{root}/{_COMMITS}/*.json").filter(F.col("file").isNotNull())
    )
    lines = spark.read.schema(SCHEMA).json(f"{root}/{_FILES}").select("*", F.col("_metadata.file_name").alias("file"))
    # Half a line of a bulk that failed has no id.
    met = lines.filter(F.col("id").isNotNull()).join(named, "file")
    newest = Window.partitionBy("index", "id").orderBy(F.desc("commit"), F.desc("file"))
    ranked = met.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") == 1)
    return ranked.select("index", "id", "value")
