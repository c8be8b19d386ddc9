"""Python data sources: a mailbox read by ranges of pages, and a document store written with one commit.

Both reach their service through a client that an option names as ``module:name``; it is called with
the option ``path``. The clients here keep pages and documents in a folder that all machines share.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Pages that one task reads.
PAGES_A_TASK = 4


def _client(options: dict):
    module, _, name = options.get("client", f"{__name__}:{options['folder_client']}").partition(":")
    return getattr(importlib.import_module(module), name)(options["path"])


class Folder:
    """Files below a path; a plain path is local, others are what pyarrow opens."""

    def __init__(self, path: str):
        self.fs, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def names(self, *parts: str) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector("/".join([self.root, *parts]), allow_not_found=True))
        return sorted(f.base_name for f in found if not f.base_name.startswith(("_", ".")))

    def lines(self, *parts: str) -> Iterator[str]:
        with self.fs.open_input_stream("/".join([self.root, *parts])) as f:
            left = b""
            while part := f.read(1 << 20):
                *whole, left = (left + part).split(b"\n")
                yield from (x.decode() for x in whole)
            if left:
                yield left.decode()

    def write(self, text: Iterator[str], *parts: str) -> None:
        """The file appears under its name when it is whole."""
        self.fs.create_dir("/".join([self.root, *parts[:-1]]))
        hidden = "/".join([self.root, *parts[:-1], f"_{uuid.uuid4().hex}"])
        with self.fs.open_output_stream(hidden) as f:
            for line in text:
                f.write(line.encode() + b"\n")
        self.fs.move(hidden, "/".join([self.root, *parts]))

    def remove(self, *parts: str) -> None:
        self.fs.delete_file("/".join([self.root, *parts]))


# --- mailbox ----------------------------------------------------------------------------------------


class FolderMailbox(Folder):
    """Pages as folders ``page=N`` of JSON lines, from 0 on; a page that is listed doesn't change any more."""

    def pages(self) -> int:
        return 1 + max((int(n.removeprefix("page=")) for n in self.names() if n.startswith("page=")), default=-1)

    def messages(self, page: int) -> Iterator[dict]:
        for name in self.names(f"page={page}"):
            yield from (json.loads(x) for x in self.lines(f"page={page}", name))


@dataclass
class Pages(InputPartition):
    first: int
    end: int


class _Read:
    def __init__(self, options: dict):
        self.options = options

    def ranges(self, first: int, end: int) -> list[Pages]:
        step = int(self.options.get("pagesATask", PAGES_A_TASK))
        return [Pages(a, min(a + step, end)) for a in range(first, end, step)]

    def read(self, part: Pages) -> Iterator[tuple]:
        box = _client(self.options)
        for page in range(part.first, part.end):
            for m in box.messages(page):
                payload = m.get("payload")
                yield (page, m.get("id"), m.get("internalDate"), None if payload is None else json.dumps(payload))


class MailboxReader(_Read, DataSourceReader):
    def partitions(self) -> list[Pages]:
        """An empty mailbox is one empty range."""
        return self.ranges(0, _client(self.options).pages()) or [Pages(0, 0)]


class MailboxStream(_Read, DataSourceStreamReader):
    """Offsets are numbers of pages; a batch has the pages that came since the one before."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"page": _client(self.options).pages()}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self.ranges(start["page"], end["page"])


class Mailbox(DataSource):
    """Messages (page, message_id, internal_date_ms, payload_json), as a table or a stream. Ids don't pass through the driver."""

    @classmethod
    def name(cls) -> str:
        return "mailbox"

    def schema(self) -> str:
        return "page int, message_id string, internal_date_ms string, payload_json string"

    def _options(self) -> dict:
        asked = {"pagesATask": self.options["pagesATask"]} if "pagesATask" in self.options else {}
        return {"folder_client": "FolderMailbox", **dict(self.options)} | asked

    def reader(self, schema) -> DataSourceReader:
        return MailboxReader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return MailboxStream(self._options())


# --- document store -----------------------------------------------------------------------------------


class FolderStore(Folder):
    """Each task attempt's documents in a file of its own; a commit is one file that names the attempts that count."""

    def stage(self, attempt: str, rows: Iterator[str]) -> None:
        self.write(rows, "attempts", attempt)

    def publish(self, attempts: Sequence[str]) -> None:
        self.write(iter(attempts), "commits", f"{len(self.names('commits')):09d}-{uuid.uuid4().hex}")

    def discard(self, attempts: Sequence[str]) -> None:
        there = set(self.names("attempts"))
        for a in attempts:
            if a in there:
                self.remove("attempts", a)


@dataclass
class Staged(WriterCommitMessage):
    attempt: str


class StoreWriter(DataSourceWriter):
    """Tasks stage, the driver publishes all or nothing. What a killed attempt staged is never named by a commit."""

    def __init__(self, options: dict):
        self.options = options

    def write(self, rows) -> Staged:
        attempt = uuid.uuid4().hex
        _client(self.options).stage(attempt, (json.dumps([r.path, r.json]) for r in rows))
        return Staged(attempt)

    def commit(self, messages: list) -> None:
        _client(self.options).publish([m.attempt for m in messages if m])

    def abort(self, messages: list) -> None:
        _client(self.options).discard([m.attempt for m in messages if m])


class DocumentStore(DataSource):
    """Takes rows (path, json) by ``df.write.format("documentstore").mode("append")``."""

    @classmethod
    def name(cls) -> str:
        return "documentstore"

    def schema(self) -> str:
        return "path string, json string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return StoreWriter({"folder_client": "FolderStore", **dict(self.options)})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Mailbox)
    spark.dataSource.register(DocumentStore)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """What a folder store's commits show: path, json of the last commit that has the path; within a commit, the greatest json."""
    store = FolderStore(path)
    if not store.names("commits"):
        return spark.createDataFrame([], "path string, json string")
    named = spark.read.text(f"{path}/commits").select(F.col("value").alias("_attempt"), F.regexp_extract("_metadata.file_name", r"^\d+", 0).alias("_commit"))
    rows = spark.read.text(f"{path}/attempts").select(F.from_json("value", "array<string>").alias("r"), F.col("_metadata.file_name").alias("_attempt"))
    seen = rows.join(named, "_attempt").groupBy(F.col("r")[0].alias("path")).agg(F.max(F.struct("_commit", F.col("r")[1].alias("json"))).alias("m"))
    return seen.select("path", "m.json")
