"""Publishing sessions with a manifest and a generated dataset card.

The files of a session are copied by tasks into the repository's staging folder; a task tells
path, bytes, rows and SHA-256 of what it has written.  One commit then moves them to
data/<session>/ and, last, the new manifest to its place.  A killed upload leaves data and
manifest as they were; a commit that was cut off is carried on by the next call.

The manifest (manifest.json) lists the files of each session.  One publisher at a time writes
to a repository.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Iterator
from pathlib import Path
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import BILL_RECORD
from .sources import staging
from .sources.sinks import write_session_files

log = logging.getLogger(__name__)
MANIFEST = "manifest.json"
COPY_BYTES = 4 << 20


class Publisher(Protocol):
    """Where a data set is published: a root that tasks can write below, and small texts; a
    hub client is another implementation."""

    @property
    def root(self) -> str: ...

    def note(self, message: str) -> None: ...

    def upload_text(self, text: str, target: str, message: str) -> None: ...

    def paths(self, below: str) -> list[str]: ...


class FolderPublisher:
    """A folder (URI or path) as the published repository, with a log of messages."""

    def __init__(self, root: str | Path):
        self.root = str(Path(root).absolute()) if "://" not in str(root) else str(root)
        self.messages: list[str] = []

    def note(self, message: str) -> None:
        self.messages.append(message)

    def upload_text(self, text: str, target: str, message: str) -> None:
        store, top = staging.opened(self.root)
        job = staging.new_job()
        folder = f"{top}/{staging.STAGED}/{job}"
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/text") as out:
            out.write(text.encode())
        staging.commit(self.root, job, [("text", target)])
        self.note(message)

    def paths(self, below: str) -> list[str]:
        store, top = staging.opened(self.root)
        found = store.get_file_info(fs.FileSelector(f"{top}/{below}", allow_not_found=True))
        return sorted(f"{below}/{x.base_name}" for x in found)


def manifest(root: str) -> dict[str, list[dict[str, Any]]]:
    """session -> its files: path, bytes, rows and sha256; empty before the first commit."""
    store, top = staging.opened(root)
    if store.get_file_info(f"{top}/{MANIFEST}").type == fs.FileType.NotFound:
        return {}
    with store.open_input_stream(f"{top}/{MANIFEST}") as f:
        return json.loads(f.read())


def published(spark: SparkSession, root: str, *only: int) -> DataFrame:
    """The records that the manifest names, of all sessions or some."""
    have = manifest(root)
    files = [f"{root.rstrip('/')}/{x['path']}" for s, xs in sorted(have.items()) if not only or int(s) in only for x in xs]
    return spark.read.schema(BILL_RECORD).parquet(*files) if files else spark.createDataFrame([], BILL_RECORD)


def uploaded(spark: SparkSession, files: list[str], root: str, job: str) -> DataFrame:
    """Copy files to the staging folder of `job`, a task each: name, bytes, rows, sha256."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, top = staging.opened(root)
        to.create_dir(f"{top}/{staging.STAGED}/{job}", recursive=True)
        for batch in batches:
            for at, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = staging.opened(path)
                digest, size, staged = hashlib.sha256(), 0, f"{at}-{staging.new_job()}"
                with store.open_input_stream(place) as source, to.open_output_stream(f"{top}/{staging.STAGED}/{job}/{staged}") as target:
                    while data := source.read(COPY_BYTES):
                        target.write(data)
                        digest.update(data)
                        size += len(data)
                with to.open_input_file(f"{top}/{staging.STAGED}/{job}/{staged}") as f:
                    rows = pq.ParquetFile(f).metadata.num_rows
                cells = [path.rpartition("/")[2]], [staged], [size], [rows], [digest.hexdigest()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["name", "staged", "bytes", "rows", "sha256"])

    todo = spark.createDataFrame(list(enumerate(files)), "at long, path string").repartitionByRange(max(1, len(files)), "at")
    return todo.mapInArrow(emit, "name string, staged string, bytes long, rows long, sha256 string")


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of its file system, as Hadoop resolves it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(p).toString()


def publish_session(records: DataFrame, session: int, publisher: Publisher, work: str | Path) -> int:
    """Write one session's records below `work`, upload its files, commit; the number of rows,
    which is counted while they are written and checked against the files uploaded."""
    spark, root = records.sparkSession, publisher.root
    staging.recover(root)
    done = write_session_files(records, session, str(work))
    job, n = staging.new_job(), done.counted["rows"]
    try:
        sent = sorted(uploaded(spark, [qualified(spark, f) for f in done.files], root, job).collect())
        if sum(r["rows"] for r in sent) != n:
            raise RuntimeError(f"session {session}: {n} rows written, {sum(r['rows'] for r in sent)} uploaded")
        have = manifest(root)
        old = {x["path"] for x in have.get(str(session), [])}
        have[str(session)] = [{"path": f"data/{session}/{r['name']}", "bytes": r["bytes"], "rows": r["rows"], "sha256": r["sha256"]} for r in sent]
        store, top = staging.opened(root)
        store.create_dir(f"{top}/{staging.STAGED}/{job}", recursive=True)
        with store.open_output_stream(f"{top}/{staging.STAGED}/{job}/{MANIFEST}") as out:
            out.write(json.dumps(have, indent=1, sort_keys=True).encode())
    except BaseException:
        staging.abort(root, job)
        raise
    new = {x["path"] for x in have[str(session)]}
    staging.commit(root, job, [*[(r["staged"], f"data/{session}/{r['name']}") for r in sent], (MANIFEST, MANIFEST)], sorted(old - new))
    publisher.note(f"Session {session}: {n} records")
    return n


def session_numbers(paths: DataFrame, column: str = "path") -> DataFrame:
    """Sessions named by numeric last parts of the paths, in ascending order."""
    name = F.element_at(F.split(column, "/"), -1)
    return paths.select(name.alias("s")).where(F.col("s").rlike(r"^\d+$")).select(F.col("s").try_cast("int").alias("session")).distinct().orderBy("session")


def config_lines(sessions: DataFrame) -> DataFrame:
    """The card's entry for each session."""
    return sessions.select("session", F.format_string('  - config_name: "%d"\n    data_files:\n      - split: train\n        path: "data/%d/*.parquet"', "session", "session").alias("config"))


def dataset_card(sessions: list[int], name: str, dataset: str, source: str) -> str:
    configs = "\n".join(f'  - config_name: "{s}"\n    data_files:\n      - split: train\n        path: "data/{s}/*.parquet"' for s in sessions)
    columns = "\n".join(f"| `{f.name}` | {f.dataType.simpleString()} |" for f in BILL_RECORD)
    return f"""---
pretty_name: {name}
language: [en]
configs:
  - config_name: "all"
    default: true
    data_files:
      - split: train
        path: "data/**/*.parquet"
{configs}
---

# {name}

Full text and metadata of bills and amendments.  Data set `{dataset}`; each session is a
configuration of its own.  Source: {source}

| Column | Type |
|---|---|
{columns}
"""


def sync_card(publisher: Publisher, name: str, dataset: str, source: str) -> bool:
    """Write the card for the sessions found; without any, warn and do nothing."""
    parts = (p.rsplit("/", 1)[-1] for p in publisher.paths("data"))
    sessions = sorted(int(p) for p in parts if p.isdigit())
    if not sessions:
        log.warning("no sessions found; the card stays as it is")
        return False
    publisher.upload_text(dataset_card(sessions, name, dataset, source), "README.md", f"Card of {len(sessions)} sessions, {sessions[0]} to {sessions[-1]}")
    return True
