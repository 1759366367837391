"""Reading landed files: binary with a pluggable decoder, text, pages, results and tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..schemas import BILL_RECORD, TEST_RESULT

Decoder = Callable[[bytes], list[str]]  # content to the text of each page


def binary_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """path, filename (without suffix) and content."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return df.select("path", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "").alias("filename"), "content")


def decoded(files: DataFrame, decoder: Decoder) -> DataFrame:
    """Files with `pages` or, where the decoder fails, `error`."""

    @F.pandas_udf("pages array<string>, error string")
    def decode(content: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in content:
            out = []
            for data in batch:
                if data is None:  # nothing was fetched; that has an error of its own
                    out.append((None, None))
                    continue
                try:
                    out.append((decoder(bytes(data)), None))
                except Exception as e:  # kept as a row, so that one bad file never fails the job
                    out.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["pages", "error"])

    d = files.withColumn("_d", decode("content"))
    return d.select(*files.columns, F.col("_d.pages").alias("pages"), F.col("_d.error").alias("error"))


def pdf_pages(content: bytes) -> list[str]:
    """The text of each page of a PDF; needs a PDF library on the executors."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("no PDF library is installed; name another decoder") from e
    with fitz.open(stream=content, filetype="pdf") as pdf:
        return [page.get_text() for page in pdf]


def text_of_pages(pages: Column) -> Column:
    """Pages joined by line ends, and one at the end."""
    return F.concat(F.array_join(pages, "\n"), F.lit("\n"))


def text_of_page_lines(pages: Column) -> Column:
    """The variant without a line end at the end."""
    return F.array_join(F.flatten(F.transform(pages, lambda p: F.split(p, "\n", -1))), "\n")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("raw_text"))


def test_results(spark: SparkSession, path: str) -> DataFrame:
    """JSON results by iteration; missing files are simply not found by the pattern."""
    return spark.read.schema(TEST_RESULT).option("multiLine", True).json(path)


def sessions(spark: SparkSession, root: str, *only: int) -> DataFrame:
    """Written sessions, all or some; only their partitions are read."""
    df = spark.read.parquet(root)
    return df.where(F.col("session").isin(*only)) if only else df


def session_stream(spark: SparkSession, root: str, *only: int, files_per_trigger: int = 64) -> DataFrame:
    """Published sessions, root/<session>/train-*.parquet, as a stream: at most so many files a
    trigger, and what the checkpoint has seen isn't read again.

    A file is known by its path, so a session that is published anew under the names it had
    isn't delivered twice; read the manifest for what holds now.
    """
    which = "{" + ",".join(map(str, only)) + "}" if only else "*"
    stream = spark.readStream.schema(BILL_RECORD).option("maxFilesPerTrigger", files_per_trigger)
    return stream.option("pathGlobFilter", "train-*.parquet").parquet(f"{root.rstrip('/')}/{which}")


def consume(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Give all that is there to `handle`, batch by batch, and return.  A batch that failed
    comes again under its number; finished ones don't."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


Position = tuple[str, int]  # a file, and the number of a row in it


def iterate(spark: SparkSession, root: str, *only: int, after: Position | None = None) -> Iterator[tuple[Position, Row]]:
    """Rows of published sessions one by one, with their positions, from the one after `after`.

    Files come in the order of their names, rows in that of the file; the driver holds one
    partition of one file at a time.
    """
    df = spark.read.schema(BILL_RECORD).option("pathGlobFilter", "train-*.parquet").option("recursiveFileLookup", True).parquet(*([f"{root.rstrip('/')}/{s}" for s in only] or [root]))
    for path in sorted(df.inputFiles()):
        if after and path < after[0]:
            continue
        rows = spark.read.schema(BILL_RECORD).parquet(path).select("*", F.col("_metadata.row_index").alias("_at"))
        if after and path == after[0]:
            rows = rows.where(F.col("_at") > after[1])
        for r in rows.sortWithinPartitions("_at").toLocalIterator():
            *values, at = r
            yield (path, at), Row(*BILL_RECORD.fieldNames())(*values)
