"""Shared pieces: reading tables, the checkpoint folder, and vectorised text kernels.

The kernels work on one *chunk* of documents at a time: a zero-copy view of the UTF-8
bytes of a slice of an Arrow batch plus the document offsets.  A chunk holds about a
megabyte of text (one document if that is longer), which bounds a task's memory by the
longest document and not by the Arrow batch.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK_BYTES = 1 << 20
ARROW_BYTES = 4 << 20  # of rows that are sent to a Python worker at a time
U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set, read by Spark alone (the folder may be in any store)."""
    # where the package isn't installed, Python workers find it beside this checkout
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the cluster names."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    Only where it is unset, as in tests, one below the warehouse is taken.
    """
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return place or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def materialised(df: DataFrame) -> DataFrame:
    """Written once as Parquet to the shared folder and read back: lineage ends there, and a
    lost executor costs no recomputation of what came before."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of `materialised` tables that no later plan reads."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if "/tables/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def partitions_of(df: DataFrame) -> int:
    """Shuffle partitions set for the session, used where an operator deals out rows itself."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def arrow_bounded(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by bytes, unless it names a bound itself: Spark's own
    is 64 MB, which both sides hold for each task (slices of a batch keep all of it).  No row is
    left out; a longer row is a batch of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(ARROW_BYTES))


def driver_rows(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A small table of rows on the driver, handed over by Arrow: a list of tuples would go through
    Python workers on the executors, with a daemon of their own that stays."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))


def mapped(df: DataFrame, emit: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`df` by mapInArrow.  Python workers are kept for later tasks, so each task gives the
    memory it has freed back to the system at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(batches)
        _powers.clear()
        released()

    arrow_bounded(df.sparkSession)
    return df.mapInArrow(run, schema)


def released() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # there is no such call outside glibc
        ctypes.CDLL(None).malloc_trim(0)


# --------------------------------------------------------------------------- chunks


@dataclass
class Chunk:
    """Some documents: ids, all their bytes, and len(ids) + 1 offsets into the bytes."""

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    first_row: int

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def chunks(batch: pa.RecordBatch, text: str = "text", key: str = "doc_id", rows: int | None = None, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Slices of a batch of about `size` bytes (and at most `rows` rows); a null text is an empty one."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
    ids = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
    _, where, data = column.buffers()
    off = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if column.null_count:  # the bytes below a null have no meaning
        column = pa.array([x if x is not None else "" for x in column.to_pylist()], pa.large_string())
        _, where, data = column.buffers()
        off = np.frombuffer(where, np.int64)[: len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(ids):
        b = int(np.searchsorted(off, off[a] + size, "right")) - 1
        b = min(max(b, a + 1), a + (rows or len(ids)), len(ids))
        yield Chunk(ids[a:b], buf[off[a] : off[b]], off[a : b + 1] - off[a], a)
        a = b


# --------------------------------------------------------------------------- hashing

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 2**63, 256).astype(U)  # a random 64-bit code for each byte
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INV = U(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _pow(base: U, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(n + n // 8 + 1024, base, U)  # chunks differ a little in size
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over the word (in place)."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def prefix(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of codes * BASE^i, from which `span` reads the hash of any span."""
    out = np.empty(len(codes) + 1, U)
    out[0] = 0
    np.cumsum(codes * _pow(BASE, len(codes), "up"), out=out[1:])
    return out


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of codes[start:end] that doesn't depend on where the span lies."""
    h = (sums[end] - sums[start]) * _pow(BASE_INV, len(sums), "down")[start]
    return mix(h + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of twice the length at each start from the hashes `h` of `length` codes."""
    return mix(h[:-length] * U(0xA0761D6478BD642F) + h[length:] * U(0xE7037ED1A0B428DB) + U(length))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each i, by doubling the width."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """The words of a chunk: byte spans, and the range of words of each document."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # len(docs) + 1

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return span(prefix(BYTE_CODE[data]), self.start, self.end)


def words_of(c: Chunk) -> Words:
    """Maximal runs of bytes that aren't space or 0x09-0x0D, within documents."""
    n = len(c.data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(c) + 1, np.int64))
    solid = ~WHITE[c.data]
    edge = np.zeros(n + 1, bool)  # a document begins here
    edge[c.offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:n]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, c.offsets))


def owner(first: np.ndarray) -> np.ndarray:
    """For each item, the document whose range in `first` holds it."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def to_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def radix_order(*columns: np.ndarray) -> np.ndarray:
    """The stable order of rows by columns of unsigned numbers, the first one foremost: a radix
    sort by digits of 16 bits (two columns of bytes are one digit), the last digit first."""
    columns = list(columns)
    if columns[0].dtype == np.uint8:
        if len(columns) % 2:
            columns.insert(0, np.zeros(len(columns[0]), np.uint8))
        digits = [(a.astype(np.uint16) << 8) | b for a, b in zip(columns[::2], columns[1::2], strict=True)]
    else:
        digits = [(c >> c.dtype.type(k) & c.dtype.type(0xFFFF)).astype(np.uint16) for c in columns for k in reversed(range(0, max(1, int(c.max(initial=0)).bit_length()), 16))]
    order = np.argsort(digits[-1], kind="stable")
    for d in reversed(digits[:-1]):
        order = order[np.argsort(d[order], kind="stable")]
    return order


class Numbers(dict):
    """Numbers its keys in the order of first use."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values in each row."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))


def among(batch: pa.RecordBatch, name: str, c: Chunk, doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each key is in its own document's list in the batch's column `name`."""
    rows = batch.column(batch.schema.get_field_index(name)).slice(c.first_row, len(c))
    sizes = np.array([0 if x is None else x for x in rows.value_lengths().to_pylist()], np.int64)
    have = rows.flatten().to_numpy(zero_copy_only=False).view(U)
    if not len(have) or not len(key):
        return np.zeros(len(key), bool)
    salt = lambda d: (d.astype(U) + U(1)) * U(0x9FB21C651E98DF25)
    return np.isin(key ^ salt(doc), have ^ salt(np.repeat(np.arange(len(c)), sizes)))


def list_of(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    """Row i of a list column of numbers as an array; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    v = col[i].values
    return np.zeros(0, np.int64) if v is None else v.to_numpy(zero_copy_only=False)


def id_and_text(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and text alone, of rows with an id: other columns never reach an operator's joins."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id IS NOT NULL")


def numbered_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """For a table (doc_id, text) in which a doc_id has several texts: the distinct texts under
    numbers of their own, in order of doc_id and SHA-256, and (row_id, doc_id) for each row of
    `docs`, row_id being the number of its text.  None if every doc_id has one text (the usual
    case; it is found by an aggregate of hashes)."""
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    spread = docs.select("doc_id", h.alias("h")).groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b"))
    if spread.where("a <> b").isEmpty():
        return None
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), "text")
    order = rows.select("doc_id", "sha").distinct().repartitionByRange("doc_id", "sha").sortWithinPartitions("doc_id", "sha")
    numbers = materialised(order.withColumn("row_id", F.monotonically_increasing_id()))
    texts = rows.join(numbers, ["doc_id", "sha"])
    return materialised(texts.select(F.col("row_id").alias("doc_id"), "text").dropDuplicates(["doc_id"])), materialised(texts.select("row_id", "doc_id"))


# --------------------------------------------------------------------------- components


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for each node of `links` (a, b): the smallest node reachable."""
    below = rooted(links, rounds)
    return below.union(below.select(F.col("component").alias("node"), "component").distinct())


def rooted(links: DataFrame, rounds: int = 60) -> DataFrame:
    """The same without the smallest nodes themselves, which a left join doesn't need.

    Alternating large-star and small-star steps: each node links its larger, then its
    smaller neighbours to its smallest one, until there are only stars around smallest nodes
    (links that are stars already take no step).  The number of links never grows, a hub's
    links are aggregated by partial minima, and each round is checkpointed.
    """
    edges = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        ways = F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = edges.select(F.inline(ways))
        per = both.groupBy("u").agg(F.count_if(F.col("v") < F.col("u")).alias("smaller"), F.count("*").alias("n"))
        if per.where("smaller > 0 AND n > 1").isEmpty():
            break
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: a larger neighbour u of v goes to v's smallest neighbour or v itself
        large = edges.join(low.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).where("u <> v").distinct()
        edges = checkpointed(small)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
