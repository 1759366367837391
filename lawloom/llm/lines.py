"""Line dedup through a sharded minimal perfect hash over the distinct line keys.

1. Each document emits the 64-bit hash of each of its distinct long line keys.
2. A partial aggregation counts the documents of each key and finds the last holder.
3. The distinct keys are dealt to shards by hash; each shard becomes one minimal perfect
   hash with three compact arrays (fingerprint, document count, last holder).
4. Documents send their keys to the shards and probe the arrays; only keys to drop come
   back.  A shard that many documents ask (a very common line) is copied to several tasks,
   in proportion to its number of probes, so that no line's probes meet in one task.
5. The drops of each document (bounded by its own lines) meet its text, which is rewritten.

Defined results: a null or empty text is one empty line; equal lines of one document count
once towards `min_docs`; the largest doc_id holding a key keeps all its lines; rows with
the same doc_id are one holder but are each rewritten; rows without a doc_id are left out;
extra columns stay as they are (n_lines and n_dropped are replaced); a very long text or line
is hashed and rewritten whole.  Keys are equal if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U, checkpointed, chunks, id_and_text, list_of, mapped, mix, partitions_of

MIN_CHARS, MIN_DOCS = 20, 3


def line_key(line: bytes) -> bytes:
    """Stripped of space and 0x09-0x0D, A-Z lower-cased; other bytes unchanged."""
    return line.strip(b" \t\n\r\x0b\x0c").lower()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


def hash_key(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key) - (1 << 63)


# ------------------------------------------------------------ minimal perfect hash


def mph_build(keys: np.ndarray, slack: float = 2.0) -> list[tuple[int, np.ndarray]]:
    """Levels of (size, occupied bit per slot): a key belongs to the first level in which it
    alone hashes to its slot; its index is the rank of that slot among all occupied ones."""
    levels, left = [], keys.view(U).copy()
    while len(left):
        size = max(8, int(len(left) * slack))
        slot = mph_slot(left, len(levels), size)
        alone = np.bincount(slot, minlength=size) == 1
        levels.append((size, alone))
        left = left[~alone[slot]]
    return levels


def mph_slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ U((level * 0x9E3779B97F4A7C15 + 0x1234567) % (1 << 64))) % U(size)).astype(np.int64)


def mph_index(levels: list[tuple[int, np.ndarray]], keys: np.ndarray) -> np.ndarray:
    """The index of each key; any index or -1 for a key that wasn't built in."""
    keys = keys.view(U)
    out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for k, (size, alone) in enumerate(levels):
        slot = mph_slot(keys[left], k, size)
        hit = alone[slot]
        rank = np.cumsum(alone) - 1
        out[left[hit]] = base + rank[slot[hit]]
        base += int(alone.sum())
        left = left[~hit]
    return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(U) + U(0xABCDEF12345)) >> U(32)).astype(np.uint32)


def pack_shard(keys: np.ndarray, count: np.ndarray, last: np.ndarray) -> bytes:
    """One shard as bytes: levels as bit arrays, then the three value arrays in index order."""
    levels = mph_build(keys)
    at = mph_index(levels, keys)
    n = len(keys)
    fp, c, d = np.zeros(n, np.uint32), np.zeros(n, np.uint32), np.zeros(n, np.int64)
    fp[at], c[at], d[at] = fingerprint(keys), np.minimum(count, 2**32 - 1), last
    head = np.array([n, len(levels), *[s for s, _ in levels]], np.int64).tobytes()
    return head + b"".join(np.packbits(a).tobytes() for _, a in levels) + fp.tobytes() + c.tobytes() + d.tobytes()


def probe_shard(blob: bytes, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, last holder) of each key by array look-up; 0 documents if unknown."""
    n, k = np.frombuffer(blob, np.int64, 2)
    sizes = np.frombuffer(blob, np.int64, k, 16)
    at, levels = 16 + 8 * int(k), []
    for s in sizes:
        size = (int(s) + 7) // 8
        levels.append((int(s), np.unpackbits(np.frombuffer(blob, np.uint8, size, at), count=int(s)).astype(bool)))
        at += size
    fp = np.frombuffer(blob, np.uint8, 4 * n, at).view(np.uint32)
    c = np.frombuffer(blob, np.uint8, 4 * n, at + 4 * int(n)).view(np.uint32)
    d = np.frombuffer(blob[at + 8 * int(n) :], np.int64)
    i = mph_index(levels, keys)
    ok = (i >= 0) & (fp[i] == fingerprint(keys))
    return np.where(ok, c[i], 0), np.where(ok, d[i], 0)


# ------------------------------------------------------------ Spark stages


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, key): the distinct hashed keys of each document's long lines."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                ids, keys = [], []
                for i, doc in enumerate(c.ids):
                    found = {hash_key(k) for k in map(line_key, c.text(i).split(b"\n")) if long_enough(k, min_chars)}
                    keys += found
                    ids += [doc] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64())], ["doc_id", "key"])

    return mapped(docs, emit, "doc_id long, key long")


def rewrite(docs: DataFrame, min_chars: int) -> DataFrame:
    """Apply each document's `_drops` to its text; the other columns stay as they are."""
    own = [f for f in docs.schema if f.name not in ("_drops", "n_lines", "n_dropped")]
    schema = T.StructType([*own, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                texts, n_lines, n_dropped = [], [], []
                for i in range(len(c)):
                    lines = c.text(i).split(b"\n")
                    drops = set(list_of(batch, "_drops", c.first_row + i).tolist())
                    kept = lines
                    if drops:
                        kept = [x for x in lines if not (long_enough(k := line_key(x), min_chars) and hash_key(k) in drops)]
                    texts.append(b"\n".join(kept).decode())
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                columns = {f.name: batch.column(batch.schema.get_field_index(f.name)).slice(c.first_row, len(c)) for f in own}
                columns |= {"text": pa.array(texts, pa.string()), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return mapped(docs, emit, schema)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int | None = None) -> DataFrame:
    """The rows of `docs` with their text rewritten, and n_lines and n_dropped of each."""
    whole = docs.where("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")).drop("_drops")
    docs = id_and_text(docs)
    shards = shards or 2 * partitions_of(docs)
    keys = line_keys(docs, min_chars).withColumn("shard", F.pmod(F.col("key"), F.lit(shards)).cast("int"))
    stats = checkpointed(keys.groupBy("key").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("last")).withColumn("shard", F.pmod(F.col("key"), F.lit(shards)).cast("int")))

    # one number for each shard: how many copies of it share its probes
    asked = {r["shard"]: r["n"] for r in stats.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    share = max(64, 1.5 * sum(asked.values()) / shards)
    copies = F.lit([int(asked.get(s, 0) // share) + 1 for s in range(shards)])

    def build(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [k[0]], "blob": [pack_shard(pdf["key"].to_numpy(), pdf["n"].to_numpy(), pdf["last"].to_numpy())]})

    def probe(k: tuple, ask: pd.DataFrame, has: pd.DataFrame) -> pd.DataFrame:
        if ask.empty or has.empty:
            return pd.DataFrame({"doc_id": [], "key": []}, dtype="int64")
        n, last = probe_shard(has["blob"].iloc[0], ask["key"].to_numpy())
        return ask.loc[(n >= min_docs) & (ask["doc_id"].to_numpy() < last), ["doc_id", "key"]]

    index = stats.groupBy("shard").applyInPandas(build, "shard int, blob binary")
    index = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.get(copies, F.col("shard")) - 1)))
    ask = keys.withColumn("copy", F.pmod(F.xxhash64("doc_id"), F.get(copies, F.col("shard"))).cast("int"))
    drops = ask.groupBy("shard", "copy").cogroup(index.groupBy("shard", "copy")).applyInPandas(probe, "doc_id long, key long")
    drops = drops.groupBy("doc_id").agg(F.collect_set("key").alias("_drops"))
    return rewrite(whole.join(drops.hint("shuffle_hash"), "doc_id", "left"), min_chars)
