"""Records kept up to date from landing batches: one row for each source file.

<root>/data/batch=<n>/part=<session>/ holds a session as the batch left it, with the action
that made each row; state.json says which batch holds each session and which one was last.  A
batch reads the sessions it touches, merges its rows by file name and digest, writes them under
its own number and then swaps the state.  So a batch that runs again before its commit replaces
what it wrote, and one that runs again after it does nothing; the same texts under a new number
change nothing either.
"""

from __future__ import annotations

import json
from typing import Any

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import filenames
from ..operators.changes import digest, latest, merged
from ..operators.documents import bill_documents, bill_records
from ..operators.selection import valid_filenames
from ..schemas import BILL_RECORD
from ..sources import staging

KEY, STATE = "source_filename", "state.json"
ROW = T.StructType([*BILL_RECORD.fields, T.StructField("landed_at", T.TimestampType()), T.StructField("digest", T.StringType())])
STORED = T.StructType([*ROW.fields, T.StructField("action", T.StringType())])
DIGESTED = [n for n in BILL_RECORD.fieldNames() if n != "scraped_at"]


class UpsertTable:
    """A table of records below `root`, a URI or path that Spark and pyarrow can open."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def state(self) -> dict[str, Any]:
        store, top = staging.opened(self.root)
        if store.get_file_info(f"{top}/{STATE}").type == fs.FileType.NotFound:
            return {"batch": -1, "sessions": {}}
        with store.open_input_stream(f"{top}/{STATE}") as f:
            return json.loads(f.read())

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(*paths) if paths else self.spark.createDataFrame([], STORED)

    def current(self, *only: int) -> DataFrame:
        """The records that hold now, with landed_at and digest."""
        have = self.state()["sessions"]
        rows = self._read([f"{self.root}/{p}" for s, p in sorted(have.items()) if not only or int(s) in only])
        return rows.where("action <> 'vanish'").drop("action")

    def changes(self, batch: int) -> DataFrame:
        """The rows that a batch inserted, changed or (as they were) removed."""
        return self._read([f"{self.root}/data/batch={batch}"]).where("action <> 'same'")

    def apply(self, records: DataFrame, batch: int, sessions: list[int], complete: bool = False) -> bool:
        """Merge records (columns of ROW) of `sessions`; with `complete`, what they lack in these
        sessions vanishes.  False: the batch had been applied before."""
        state = self.state()
        if batch <= state["batch"]:
            return False
        held = [p for s in sessions if (p := state["sessions"].get(str(s)))]
        before = self._read([f"{self.root}/{p}" for p in held]).where("action <> 'vanish'").drop("action")
        rows = merged(before, latest(records, KEY, "landed_at", "digest"), KEY, complete=F.lit(complete))
        place = f"data/batch={batch}"
        rows.withColumn("part", F.col("session")).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/{place}")
        state = {"batch": batch, "sessions": state["sessions"] | {str(s): f"{place}/part={s}" for s in sessions}}
        store, top = staging.opened(self.root)
        job = staging.new_job()
        store.create_dir(f"{top}/{staging.STAGED}/{job}", recursive=True)
        with store.open_output_stream(f"{top}/{staging.STAGED}/{job}/{STATE}") as out:
            out.write(json.dumps(state).encode())
        staging.commit(self.root, job, [(STATE, STATE)])
        return True


def digested(landed: DataFrame, base_url: str, scraped_at: Column | None = None) -> DataFrame:
    """Records of landed texts with landed_at and digest (of all but the time of scraping)."""
    docs = bill_documents(valid_filenames(landed))
    return bill_records(docs, base_url, scraped_at=scraped_at, keep=("landed_at",)).withColumn("digest", digest(*DIGESTED)).select(*ROW.fieldNames())


def upsert(landed: DataFrame, base_url: str, table: UpsertTable, checkpoint: str, scraped_at: Column | None = None, complete: bool = False):
    """Apply a landing stream's batches to `table`; returns the started query.

    complete: each batch holds its sessions whole, as after a scrape of all of them.
    """

    def each(batch: DataFrame, number: int) -> None:
        staging.recover(table.root)
        names = valid_filenames(batch).select(filenames.parsed(F.col("filename"))["session"].cast("int").alias("session"))
        touched = sorted(r["session"] for r in names.distinct().collect())
        if touched:
            table.apply(digested(batch, base_url, scraped_at), number, touched, complete)

    return landed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
