"""Writing records by session, documents as JSON, texts, and results."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..schemas import BILL_RECORD
from . import staging


class Written(NamedTuple):
    """The files of a session, and what was counted while they were written."""

    files: list[str]
    counted: dict[str, Any]




def write_sessions(records: DataFrame, root: str, rows_per_file: int = 1_000_000) -> None:
    """Replace the sessions in `records` below root/session=<n>, and leave the others.

    Rows are rebalanced by session: from the sizes of the shuffle AQE cuts a large session into
    several tasks and joins small ones, whatever their number.
    """
    dealt = records.hint("rebalance", "session")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).partitionBy("session").parquet(root)


def read_sessions(df: DataFrame) -> DataFrame:
    """The columns in the published order (Spark puts the partition's last)."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in BILL_RECORD])


def document_json(docs: DataFrame, *columns: str) -> Column:
    """A document as JSON text, dates as ISO, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"})


def write_json(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_texts(docs: DataFrame, path: str, column: str = "body_text") -> None:
    """Many texts to a file, as Spark writes text."""
    docs.select(column).write.mode("overwrite").text(path)


@dataclass
class Staged(WriterCommitMessage):
    """What one task has written: its folder below the job's, and the names of its files."""

    folder: str
    names: list[str]


class FileWriter(DataSourceArrowWriter):
    """Rows (name, content) as files root/<name>, all of them or none; see `staging`.

    Each attempt of a task has a folder of its own, and only the folders of the attempts that
    Spark commits are moved, so that failed and speculative attempts leave no file.
    """

    def __init__(self, root: str):
        self.root, self.job = root, staging.new_job()

    def write(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        store, top = staging.opened(self.root)
        folder, names = staging.new_job(), []
        place = f"{top}/{staging.STAGED}/{self.job}/{folder}"
        store.create_dir(place, recursive=True)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                staging.checked(name)
                with store.open_output_stream(f"{place}/{len(names)}") as out:
                    out.write((text or "").encode())
                names.append(name)
        return Staged(folder, names)

    def commit(self, messages: list[Staged | None]) -> None:
        staging.commit(self.root, self.job, [(f"{m.folder}/{k}", name) for m in messages if m for k, name in enumerate(m.names)])

    def abort(self, messages: list[Staged | None]) -> None:
        staging.abort(self.root, self.job)


class FileSink(DataSource):
    """df.write.format("files").option("path", root): a file for each row (name, content)."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"])


def write_files(docs: DataFrame, root: str, name: Column, content: Column) -> int:
    """A file of its own for each row, root/<name> with `content` as UTF-8, by the tasks that
    hold the rows; folders are made, files replaced, and all appear together.  Returns the
    number of files, counted while they are written.

    Rows without a name are left out; names that leave root, and two rows of one name, are
    errors.  `root` is a URI or path that the executors share and pyarrow can open.
    """
    spark = docs.sparkSession
    spark.dataSource.register(FileSink)
    staging.recover(root)
    seen = Observation()
    rows = docs.select(name.cast("string").alias("name"), content.cast("string").alias("content")).where("name IS NOT NULL")
    rows.observe(seen, F.count("*").alias("n")).write.format("files").option("path", root).mode("append").save()
    return seen.get["n"]


def write_result(result: DataFrame, root: str, name: str) -> int:
    """A result of one row (rates, a gate, counts of tests) as root/<name>.json."""
    return write_files(result.limit(1), root, F.lit(f"{name}.json"), document_json(result, *result.columns))


def write_session_files(records: DataFrame, session: int, root: str, rows_per_file: int = 1_000_000, measures: Mapping[str, Column] | None = None) -> Written:
    """One session's records, `session` among the columns, as root/<session>/train-<k>-of-<n>.parquet.

    Rows, and the means of `measures` (named columns), are counted by the writing plan itself,
    so a session is scanned once.
    """
    place = f"{root}/{session}"
    rows = records.where(F.col("session") == session)
    seen = Observation()
    told = {"rows": F.count("*"), **{k: F.avg(c) for k, c in (measures or {}).items()}}
    rows = rows.observe(seen, *[c.alias(k) for k, c in told.items()])
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(place)
    return Written(named_parts(records.sparkSession, place), seen.get)


def write_all_session_files(records: DataFrame, sessions: Sequence[int], root: str, rows_per_file: int = 1_000_000, measures: Mapping[str, Column] | None = None) -> dict[int, Written]:
    """The same for several sessions from one scan of `records`.

    They are written together below root and renamed one by one, each replacing what was there.
    """
    spark, place = records.sparkSession, f"{root}/_writing/{staging.new_job()}"
    seen = Observation()
    mine = {s: F.col("session") == s for s in sessions}
    told = {f"rows {s}": F.count_if(own) for s, own in mine.items()}
    told |= {f"{k} {s}": F.avg(F.when(own, c)) for s, own in mine.items() for k, c in (measures or {}).items()}
    rows = records.where(F.col("session").isin(*sessions)).observe(seen, *[c.alias(k) for k, c in told.items()])
    parts = rows.withColumn("part", F.col("session")).hint("rebalance", "part")
    parts.write.option("maxRecordsPerFile", rows_per_file).partitionBy("part").parquet(place)
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for s in sessions:
        written, final = path(f"{place}/part={s}"), path(f"{root}/{s}")
        if not store.exists(written):  # no rows: a file that has the columns
            spark.createDataFrame([], records.schema).coalesce(1).write.parquet(f"{place}/part={s}")
        store.delete(final, True)
        store.rename(written, final)
        out[s] = Written(named_parts(spark, f"{root}/{s}"), {k: seen.get[f"{k} {s}"] for k in ("rows", *(measures or {}))})
    store.delete(path(place), True)
    return out


def named_parts(spark: SparkSession, place: str) -> list[str]:
    """Rename the part files of a written folder in order, through Hadoop's file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    top = path(place)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(x.getPath().getName() for x in store.listStatus(top) if x.getPath().getName().startswith("part-"))
    names = [f"train-{k:05d}-of-{len(parts):05d}.parquet" for k in range(len(parts))]
    for a, b in zip(parts, names, strict=True):
        store.rename(path(top, a), path(top, b))
    return [f"{place}/{b}" for b in names]
