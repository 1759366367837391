"""Structured Streaming over a landing folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.documents import bill_documents, bill_records
from ..operators.selection import valid_filenames

LANDED = T.StructType([T.StructField("filename", T.StringType()), T.StructField("raw_text", T.StringType())])


def landing(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Texts as they land, with the time of their file; the checkpoint remembers the files already read."""
    files = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return files.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def ingest(landed: DataFrame, base_url: str, out: str, checkpoint: str, scraped_at: Column | None = None):
    """Records appended by session, each file once; returns the started query."""
    records = bill_records(bill_documents(valid_filenames(landed)), base_url, scraped_at=scraped_at)
    return records.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("session").outputMode("append").trigger(availableNow=True).start(out)


def counts_by_session(records: DataFrame) -> DataFrame:
    """Running counts by session and type, for a complete-mode sink."""
    return records.groupBy("session", "document_type").agg(F.count("*").alias("n"))
