"""Substring dedup by level-wise doubling of word windows.

A window of `width` words (20) can only be repeated if each shorter window in it is.  So
levels of 5, 10 and 20 words are tested in turn, and only windows whose shorter one is
repeated go on to twice its length:

* At the shorter lengths one window speaks for each full-width window: the one of the least
  hash among the shorter windows inside (the same one wherever the words recur), about one
  in eight.  A level keeps those found in two documents or more.
* At the last length but one, the adjacent full-width windows that share such a window form
  a run, and whole runs are compared first: a run found in an earlier document is repeated
  as a whole.  Only where one short window lies in different runs (the ends of repeated
  passages) do single full-width windows take part in the last level.

Comparisons are aggregations of (hash, least document) with partial sums and joins back,
so a passage in a third of all documents is never gathered in one task.  Repeats within a
document are found where its text is.  Equality is that of 64-bit hashes.

Defined results: a null or empty text has no words; a text shorter than the window keeps
all; rows of equal doc_id do not count as earlier than each other, and repeated rows are
cut alike; of windows of one document the first stays; a very long text is read whole, in a
chunk of its own; rows without a doc_id are left out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, Chunk, Words, among, chunks, doubled, id_and_text, mapped, materialised, mix, owner, prefix, sliding_min, span, to_long, words_of

WIDTH = 20


def lengths(width: int, least: int = 5) -> list[int]:
    """Window lengths by doubling, from the shortest of at least `least` up to `width`."""
    out = [width]
    while out[0] % 2 == 0 and out[0] // 2 >= least:
        out.insert(0, out[0] // 2)
    return out


@dataclass
class Windows:
    """The full-width windows of a chunk."""

    words: Words
    at: np.ndarray  # first word
    doc: np.ndarray
    keys: list[np.ndarray]  # for each shorter length, the hash that speaks for the window
    full: np.ndarray  # hash of the window


def windows_of(c: Chunk, width: int) -> Windows:
    w = words_of(c)
    n, levels = len(w.start), lengths(width)
    doc = owner(w.first)
    at = np.flatnonzero(np.arange(n) + width <= w.first[1:][doc]) if n else np.zeros(0, np.int64)
    if not len(at):
        z = np.zeros(0, U)
        return Windows(w, at, doc[at], [z] * (len(levels) - 1), z)
    sums = prefix(w.hashes(c.data))
    i = np.arange(n - levels[0] + 1)
    h, keys = span(sums, i, i + levels[0]), []
    for length in levels[:-1]:
        keys.append(sliding_min(h, width - length + 1)[at])
        h = doubled(h, length)
    return Windows(w, at, doc[at], keys, h[at])


def runs_of(w: Windows, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, end, hash) of each run: adjacent windows of a document that share keys[level]."""
    n = len(w.at)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z.view(U)
    key = w.keys[level]
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (w.doc[1:] != w.doc[:-1]) | (w.at[1:] != w.at[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], n)
    return a, b, span(prefix(w.full), a, b)


def distinct(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Indices of the first of each distinct (doc, keys)."""
    h = doc.astype(U) * U(0x9FB21C651E98DF25)
    for k in keys:
        h = mix(h + k)
    return np.unique(h, return_index=True)[1]


def rows(c: Chunk, pick: np.ndarray, doc: np.ndarray, **keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.ids[doc[pick]], pa.int64()), *[pa.array(to_long(k[pick])) for k in keys.values()]], ["doc_id", *keys])


def alive(batch: pa.RecordBatch, c: Chunk, w: Windows, level: int) -> np.ndarray:
    """Windows whose shorter window of the level before is repeated."""
    return among(batch, "keys", c, w.doc, w.keys[level - 1]) if level else np.ones(len(w.at), bool)


def level_keys(docs: DataFrame, width: int, level: int) -> DataFrame:
    """(doc_id, key) of a shorter length for the windows still alive."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                w = windows_of(c, width)
                on = np.flatnonzero(alive(batch, c, w, level))
                pick = on[distinct(w.doc[on], w.keys[level][on])]
                yield rows(c, pick, w.doc, key=w.keys[level])

    return mapped(docs, emit, "doc_id long, key long")


def level_runs(docs: DataFrame, width: int, level: int) -> DataFrame:
    """(doc_id, key, run) of the last length but one for the runs still alive."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                w = windows_of(c, width)
                a, _, run = runs_of(w, level)
                on = np.flatnonzero(np.logical_or.reduceat(alive(batch, c, w, level), a)) if len(a) else a
                doc, key = w.doc[a], w.keys[level][a]
                pick = on[distinct(doc[on], key[on], run[on])]
                yield rows(c, pick, doc, key=key, run=run)

    return mapped(docs, emit, "doc_id long, key long, run long")


def level_windows(docs: DataFrame, width: int, level: int) -> DataFrame:
    """(doc_id, win): the full-width windows of each document's runs in its list `open`."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                w = windows_of(c, width)
                if level >= 0:
                    a, b, run = runs_of(w, level)
                    on = np.flatnonzero(np.repeat(among(batch, "open", c, w.doc[a], run), b - a))
                else:
                    on = np.arange(len(w.at))
                pick = on[distinct(w.doc[on], w.full[on])]
                yield rows(c, pick, w.doc, win=w.full)

    return mapped(docs, emit, "doc_id long, win long")


def seen_before(hits: DataFrame, key: str) -> DataFrame:
    """The rows (doc_id, key) whose key also lies in a smaller doc_id."""
    first = hits.groupBy(key).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_first < _last")
    return hits.join(first, key).where("doc_id > _first").select("doc_id", key)


def repeated_within(doc: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Windows (in order) that also start earlier in their own document."""
    h = mix(full + doc.astype(U) * U(0x9FB21C651E98DF25))
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros(len(h), bool)
    if len(twice):
        some = np.flatnonzero(np.isin(h, twice))
        first = np.unique(h[some], return_index=True)[1]
        out[some] = True
        out[some[first]] = False
    return out


def cut(docs: DataFrame, width: int, level: int) -> DataFrame:
    """Remove the words covered by repeated windows: those of listed runs, those listed
    alone, and those that start earlier in the same text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n_words, removed, texts = [], [], [], []
            for c in chunks(batch):
                w = windows_of(c, width)
                bad = repeated_within(w.doc, w.full) | among(batch, "wins", c, w.doc, w.full)
                if level >= 0:
                    a, b, run = runs_of(w, level)
                    bad |= np.repeat(among(batch, "runs", c, w.doc[a], run), b - a)
                n = len(w.words.start)
                step = np.zeros(n + 1, np.int64)
                np.add.at(step, w.at[bad], 1)
                np.add.at(step, w.at[bad] + width, -1)
                keep = np.cumsum(step)[:n] == 0
                first = w.words.first
                for i, doc in enumerate(c.ids):
                    own = keep[first[i] : first[i + 1]]
                    words = c.text(i).split()
                    gone = len(own) - int(own.sum())
                    ids.append(doc)
                    n_words.append(len(own))
                    removed.append(gone)
                    texts.append(b" ".join(compress(words, own.tolist()) if gone else words).decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return mapped(docs, emit, "doc_id long, n_words long, n_removed long, kept_text string")


def dedup_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by a space) of each row."""
    docs = id_and_text(docs)
    last = len(lengths(width)) - 2  # index of the length whose runs are compared; -1: none
    told, runs = docs, None
    for level in range(last):
        hits = materialised(level_keys(told, width, level))
        many = hits.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("key")
        keys = hits.join(many, "key", "left_semi").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
        told = docs.join(keys.hint("shuffle_hash"), "doc_id")
    if last >= 0:
        hits = materialised(level_runs(told, width, last))
        first = hits.groupBy("key", "run").agg(F.min("doc_id").alias("first"))
        mixed = hits.groupBy("key").agg(F.min("run").alias("a"), F.max("run").alias("b")).where("a < b").select("key", F.lit(True).alias("mixed"))
        judged = hits.join(first, ["key", "run"]).where("doc_id > first").select("doc_id", "run", F.lit(False).alias("open"))
        owners = first.join(mixed, "key").select(F.col("first").alias("doc_id"), "run", F.lit(True).alias("open"))
        runs = materialised(judged.union(owners))
        told = docs.join(runs.where("open").groupBy("doc_id").agg(F.collect_set("run").alias("open")).hint("shuffle_hash"), "doc_id")
    wins = seen_before(materialised(level_windows(told, width, last)), "win")
    none = F.lit(None).cast("long")
    drops = wins.select("doc_id", "win", none.alias("run"))
    if runs is not None:
        drops = drops.union(runs.where("NOT open").select("doc_id", none.alias("win"), "run"))
    drops = drops.groupBy("doc_id").agg(F.collect_set("win").alias("wins"), F.collect_set("run").alias("runs"))
    return cut(docs.join(drops.hint("shuffle_hash"), "doc_id", "left"), width, last)
