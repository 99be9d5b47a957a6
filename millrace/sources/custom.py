"""A user-defined source and sink as a Spark data source: ``record_log``.

A folder holds files of framed records (length and UTF-8 text) and a log of commits. A file counts once
the job that wrote it has committed; a commit has a number, and its place in the log never changes.
Appends add a commit, an overwrite starts the log anew, and a stream's batch that is committed again
is there already. Reading gives one text column, ``value``, a task for each file; a stream reads commit by
commit in the order of the log. One job commits to a folder at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

COMMITS = "_commits"
CHUNK = 8 << 20  # bytes read at a time
ROWS = 10_000  # rows given to Spark at a time


class Folder:
    """The files and the log below a path or URI."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(path)

    def names(self) -> list[str]:
        """Commits in order."""
        from pyarrow import fs

        listed = self.files.get_file_info(fs.FileSelector(f"{self.root}/{COMMITS}", allow_not_found=True))
        return sorted(f.base_name for f in listed if f.base_name.endswith(".json"))

    def commit_of(self, name: str) -> dict:
        with self.files.open_input_stream(f"{self.root}/{COMMITS}/{name}") as f:
            return json.loads(f.read())

    def live(self) -> list[str]:
        """Files that count now: those committed since the last overwrite."""
        out: list[str] = []
        for name in self.names():
            commit = self.commit_of(name)
            out = [*([] if commit["overwrite"] else out), *commit["files"]]
        return out

    def commit(self, files: list[str], overwrite: bool = False, batch: int | None = None) -> None:
        names = self.names()
        mark = f"-batch{batch}.json"
        if batch is not None and any(n.endswith(mark) for n in names):
            return
        number = 1 + max((int(n.split("-")[0]) for n in names), default=0)
        name = f"{number:012d}{mark if batch is not None else '-' + uuid.uuid4().hex + '.json'}"
        self.files.create_dir(f"{self.root}/{COMMITS}", recursive=True)
        with self.files.open_output_stream(f"{self.root}/_{name}") as out:
            out.write(json.dumps({"files": files, "overwrite": overwrite}).encode())
        self.files.move(f"{self.root}/_{name}", f"{self.root}/{COMMITS}/{name}")

    def write(self, batches: Iterator) -> Written:
        self.files.create_dir(self.root, recursive=True)
        name, rows = f"part-{uuid.uuid4().hex}.rec", 0
        with self.files.open_output_stream(f"{self.root}/{name}") as out:
            for batch in batches:
                # A null record and an empty one differ by the sign of their length.
                texts = [None if v is None else v.encode() for v in batch.column(0).to_pylist()]
                out.write(b"".join((-1 if t is None else len(t)).to_bytes(4, "little", signed=True) + (t or b"") for t in texts))
                rows += len(texts)
        return Written(name, rows)

    def discard(self, messages: list) -> None:
        for m in messages:
            if m is not None:
                self.files.delete_file(f"{self.root}/{m.name}")

    def read(self, name: str) -> Iterator:
        import pyarrow as pa

        rest, values = b"", []
        with self.files.open_input_stream(f"{self.root}/{name}") as f:
            while chunk := f.read(CHUNK):
                rest, at = rest + chunk, 0
                while len(rest) - at >= 4:
                    size = int.from_bytes(rest[at:at + 4], "little", signed=True)
                    end = at + 4 + max(size, 0)
                    if end > len(rest):
                        break
                    values.append(None if size < 0 else rest[at + 4:end].decode())
                    at = end
                    if len(values) == ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])
                        values = []
                rest = rest[at:]
        if values:
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


@dataclass
class File(InputPartition):
    name: str


class RecordReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[File]:
        return [File(name) for name in Folder(self.path).live()]

    def read(self, partition: File | None) -> Iterator:
        return Folder(self.path).read(partition.name) if partition else iter(())


class RecordStream(DataSourceStreamReader):
    """The offset is the name of the last commit handed out."""

    def __init__(self, path: str) -> None:
        self.path = path

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": max(Folder(self.path).names(), default="")}

    def partitions(self, start: dict, end: dict) -> list[File]:
        folder = Folder(self.path)
        new = [n for n in folder.names() if start["after"] < n <= end["after"]]
        return [File(f) for n in new for f in folder.commit_of(n)["files"]]

    def read(self, partition: File) -> Iterator:
        return Folder(self.path).read(partition.name)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator) -> Written:
        return Folder(self.path).write(iterator)

    def commit(self, messages: list) -> None:
        Folder(self.path).commit([m.name for m in messages if m is not None and m.rows], self.overwrite)

    def abort(self, messages: list) -> None:
        Folder(self.path).discard(messages)


class RecordStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator) -> Written:
        return Folder(self.path).write(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        Folder(self.path).commit([m.name for m in messages if m is not None and m.rows], batch=batchId)

    def abort(self, messages: list, batchId: int) -> None:
        Folder(self.path).discard(messages)


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return "value STRING"

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options["path"])

    def streamReader(self, schema) -> RecordStream:
        return RecordStream(self.options["path"])

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], overwrite)

    def streamWriter(self, schema, overwrite: bool) -> RecordStreamWriter:
        return RecordStreamWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordLog)
