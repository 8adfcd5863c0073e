"""Topics as a data source of their own: messages with acknowledged, two-phase writes, and readers that follow what is committed.

    spark.dataSource.register(Topics)
    messages.writeStream.format("tidewire_topics").option("path", ...).option("checkpointLocation", ...).start()
    spark.readStream.format("tidewire_topics").option("path", ...).load()

Tasks write their messages to files of names that are theirs alone and hand these over; the commit of a batch writes one manifest that names them, by
a rename. A manifest is there or it isn't: a batch whose driver was lost before it is written again with other files, one whose
driver was lost behind it is known by its number and not written twice. Readers open what manifests name, so every message is read once.
Path: any folder that pyarrow's file systems open on the driver and on all executors (file, hdfs, object stores).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "topic string, value binary, attributes map<string,string>"
ARROW = pa.schema([("topic", pa.string()), ("value", pa.binary()), ("attributes", pa.map_(pa.string(), pa.string()))])
#: Messages that a task holds before it writes them.
HELD = 1_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Log:
    """The manifests of a path: one file a batch, named by its number."""

    def __init__(self, path: str):
        self.files, self.root = opened(path)

    def _name(self, number: int) -> str:
        return f"{self.root}/_committed/{number:020d}.json"

    def numbers(self) -> list[int]:
        """Numbers of committed batches, ascending."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/_committed", allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))

    def last(self) -> int:
        return max(self.numbers(), default=-1)

    def has(self, number: int) -> bool:
        return self.files.get_file_info(self._name(number)).type == fs.FileType.File

    def commit(self, number: int, parts: Sequence[Part]) -> bool:
        """Whether this call committed the batch; a batch that is there already stays as it is."""
        if self.has(number):
            return False
        self.files.create_dir(f"{self.root}/_committed")
        begun = f"{self.root}/_committed/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(begun) as f:
            f.write(json.dumps([{"file": p.file, "rows": p.rows} for p in parts if p.file]).encode())
        self.files.move(begun, self._name(number))
        return True

    def parts(self, number: int) -> list[Part]:
        with self.files.open_input_stream(self._name(number)) as f:
            return [Part(p["file"], p["rows"]) for p in json.loads(f.read())]

    def remove(self, parts: Sequence[Part | None]) -> None:
        for p in parts:
            if p is not None and p.file and self.files.get_file_info(f"{self.root}/{p.file}").type == fs.FileType.File:
                self.files.delete_file(f"{self.root}/{p.file}")


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote."""

    file: str | None
    rows: int


@dataclass
class File(InputPartition):
    file: str


class _Write:
    def __init__(self, path: str, form: StructType):
        self.path, self.names = path, form.names

    def write(self, iterator: Iterator) -> Part:
        """A task's messages in a file that no manifest names yet."""
        files, root = opened(self.path)
        at, count, held, file, out = [self.names.index(c) for c in ARROW.names], 0, [], None, None
        for row in iterator:
            held.append([row[k] for k in at])
            if len(held) >= HELD:
                file, out = self._put(files, root, file, out, held)
                count, held = count + len(held), []
        if held:
            file, out = self._put(files, root, file, out, held)
            count += len(held)
        if out is not None:
            out.close()
        return Part(file, count)

    @staticmethod
    def _put(files: fs.FileSystem, root: str, file: str | None, out: pq.ParquetWriter | None, rows: list) -> tuple[str, pq.ParquetWriter]:
        if out is None:
            file = f"parts/{uuid.uuid4().hex}.parquet"
            files.create_dir(f"{root}/parts")
            out = pq.ParquetWriter(f"{root}/{file}", ARROW, filesystem=files, compression="zstd")
        attributes = [None if r[2] is None else list(r[2].items()) for r in rows]
        out.write_table(pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([None if r[1] is None else bytes(r[1]) for r in rows], pa.binary()), pa.array(attributes, ARROW.field(2).type)], schema=ARROW))
        return file, out


class StreamWriter(_Write, DataSourceStreamWriter):
    """A micro-batch is one manifest, under the batch's number."""

    def commit(self, messages: list[Part | None], batchId: int) -> None:  # noqa: N803
        log = Log(self.path)
        if not log.commit(batchId, [m for m in messages if m is not None]):
            log.remove(messages)  # It was done before: what this attempt wrote is not needed.

    def abort(self, messages: list[Part | None], batchId: int) -> None:  # noqa: N803
        Log(self.path).remove(messages)


class BatchWriter(_Write, DataSourceWriter):
    """A write is one manifest, under a given number, where it is there once however often it is written, or under the next."""

    number: int | None = None

    def commit(self, messages: list[Part | None]) -> None:
        log = Log(self.path)
        if not log.commit(log.last() + 1 if self.number is None else self.number, [m for m in messages if m is not None]):
            log.remove(messages)

    def abort(self, messages: list[Part | None]) -> None:
        Log(self.path).remove(messages)


def _read(path: str, file: str) -> Iterator[pa.RecordBatch]:
    files, root = opened(path)
    with files.open_input_file(f"{root}/{file}") as f:
        yield from pq.ParquetFile(f).iter_batches(HELD)


class BatchReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[File]:
        log = Log(self.path)
        return [File(p.file) for n in log.numbers() for p in log.parts(n)] or [File("")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from _read(self.path, partition.file)


class StreamReader(DataSourceStreamReader):
    """Offsets are numbers of batches: from behind one up to another."""

    def __init__(self, path: str, most: int):
        self.path, self.most, self.at = path, most, -1

    def initialOffset(self) -> dict:  # noqa: N802
        return {"batch": -1}

    def latestOffset(self) -> dict:  # noqa: N802
        """At most `most` batches more at once, where that is asked."""
        later = [n for n in Log(self.path).numbers() if n > self.at]
        if later:
            self.at = later[min(self.most, len(later)) - 1] if self.most else later[-1]
        return {"batch": self.at}

    def partitions(self, start: dict, end: dict) -> list[File]:
        self.at = max(self.at, end["batch"])
        log = Log(self.path)
        return [File(p.file) for n in log.numbers() if start["batch"] < n <= end["batch"] for p in log.parts(n)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        yield from _read(self.path, partition.file)


class Topics(DataSource):
    """Options: path; batch: the number that a batch write is committed under; batches_a_trigger: how many committed batches a stream reads at once (0: all there are)."""

    @classmethod
    def name(cls) -> str:
        return "tidewire_topics"

    def schema(self) -> str:
        return SCHEMA

    def _path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("topics need a path")
        return self.options["path"]

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(self._path())

    def streamReader(self, schema: StructType) -> StreamReader:  # noqa: N802
        return StreamReader(self._path(), int(self.options.get("batches_a_trigger", "0")))

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("topics are appended to")
        writer = BatchWriter(self._path(), schema)
        writer.number = int(self.options["batch"]) if "batch" in self.options else None
        return writer

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:  # noqa: N802
        return StreamWriter(self._path(), schema)
