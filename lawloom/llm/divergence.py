"""Source divergence audit by sorting and scanning runs.

1. A task numbers terms and (lang, source) groups of a few million words, sorts them by
   (term, group, document) with a radix sort and scans the runs: one row for each lang, term
   and source with its documents and occurrences so far.  A frequent term or a hot source is
   thereby a row a task and source before anything is shuffled.
2. Rows are repartitioned by (lang, term) and sorted by (lang, term, source); a streaming scan
   sums equal ones, finds each term's documents and keeps the terms in `min_docs` of them.
3. Sums over the kept terms give each group its size and each language its vocabulary, hence
   the probability of every count, also of none.
4. The kept rows are scanned by term once more.  f summed over all terms for two groups is
   the sum as if both lacked every term, corrected for each term that one has (by the group's
   counts: few are different) and again for those that both have.  Only the last needs a
   run's pairs of sources; they are summed in the task and sent as partial sums.  So no row is
   made for a term that a group lacks.
5. Terms above the language's probability are ranked by group, the first `top` stay.

Every row counts as a document of its own, whatever its doc_id.

Defined results: a null text, lang or source is ''; repeated rows all count; groups without
terms appear as items and with value 0 where the language keeps no term; a lang of one source
has no pairs; equal values rank by item; a very long text is read whole (its words in one
task's memory); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Numbers, discard, mapped, materialised, radix_order

MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000  # fixed value: probabilities are counted in billionths
TASK_WORDS = 3 << 20
PAIRS = 1 << 22  # pairs of sources, or sums of pairs, held at once
# Terms are runs of letters A-Z, a-z and of all characters from U+0080 on.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


# ------------------------------------------------------------------ counts by term and source


def term_rows(docs: DataFrame, task_words: int) -> DataFrame:
    """(lang, term, source, df, n) over the documents that a task has read at a time."""

    def scanned(terms: Numbers, groups: Numbers, codes: list[np.ndarray], where: list[int]) -> Iterator[pa.RecordBatch]:
        lengths = np.fromiter(map(len, codes), np.int64, len(codes))
        code = np.concatenate(codes)
        if not len(code):
            return
        doc = np.repeat(np.arange(len(codes)), lengths)
        run = (code * len(groups) + np.array(where, np.int64)[doc]).astype(np.uint64)
        order = radix_order(run)  # stable, so documents stay in order within a run
        run, doc = run[order], doc[order]
        start = np.append(True, run[1:] != run[:-1])
        other = start.copy()
        other[1:] |= doc[1:] != doc[:-1]
        at = np.flatnonzero(start)
        term, group = np.divmod(run[at].astype(np.int64), len(groups))
        langs, sources = (pa.array([g[k] for g in groups], pa.string()).take(pa.array(group)) for k in (0, 1))
        cells = [langs, pa.array(list(terms), pa.string()).take(pa.array(term)), sources, pa.array(np.add.reduceat(other.astype(np.int64), at)), pa.array(np.diff(np.append(at, len(run))))]
        rows = pa.RecordBatch.from_arrays(cells, ["lang", "term", "source", "df", "n"])
        for k in range(0, rows.num_rows, 1 << 16):
            yield rows.slice(k, 1 << 16)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, groups, codes, where, size = Numbers(), Numbers(), [], [], 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.translate(FOLD).split()
                codes.append(np.fromiter(map(terms.__getitem__, words), np.int64, len(words)))
                where.append(groups[lang, source])
                size += len(words)
                if size >= task_words:
                    yield from scanned(terms, groups, codes, where)
                    terms, groups, codes, where, size = Numbers(), Numbers(), [], [], 0
        if codes:
            yield from scanned(terms, groups, codes, where)

    return mapped(docs, emit, "lang string, term string, source string, df long, n long")


def starts(*columns: pa.Array) -> np.ndarray:
    """Where a row differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    if len(out) > 1:
        out[1:] = np.logical_or.reduce([pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in columns])
    return out


def by_runs(batches: Iterator[pa.RecordBatch], summed: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in batches of whole (lang, term) runs; rows that are equal in all other
    columns become one, with sums."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        names = rows.schema.names
        at = np.flatnonzero(starts(*[rows.column(k) for k, name in enumerate(names) if name not in summed]))
        if summed and len(at) < rows.num_rows:
            sums = {k: pa.array(np.add.reduceat(rows.column(names.index(k)).to_numpy(), at)) for k in summed}
            rows = rows.take(pa.array(at))
            rows = pa.RecordBatch.from_arrays([sums.get(name, rows.column(k)) for k, name in enumerate(names)], names)
        last = int(np.flatnonzero(starts(rows.column(0), rows.column(1)))[-1])
        if last:
            yield rows.slice(0, last)
        rest = rows.slice(last)
    if rest is not None:
        yield rest


def kept_rows(rows: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, source, n, total, first) of the kept terms; total: n over the language,
    first: whether the row is the first of its term."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_runs(batches, ("df", "n")):
            first = starts(t.column(0), t.column(1))
            at = np.flatnonzero(first)
            size = np.diff(np.append(at, t.num_rows))
            df, n = (np.add.reduceat(t.column(k).to_numpy(), at) for k in (3, 4))
            out = pa.RecordBatch.from_arrays([*(t.column(k) for k in (0, 1, 2, 4)), pa.array(np.repeat(n, size)), pa.array(first)], ["lang", "term", "source", "n", "total", "first"])
            yield out.filter(pa.array(np.repeat(df >= min_docs, size)))

    ordered = rows.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return mapped(ordered, emit, "lang string, term string, source string, n long, total long, first boolean")


# --------------------------------------------------------------------------- divergence


def probability(count: str, size: str) -> Column:
    """1 + floor(SCALE (count + 2) / (size + 2 v)), exact; 1 where there is nothing to count."""
    ratio = f"(CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(19, 0))) div CAST({size} + 2 * v AS DECIMAL(19, 0))"
    return F.expr(f"CASE WHEN {size} + 2 * v = 0 THEN 1L ELSE 1 + {ratio} END")


def gap(p: str, q: str) -> str:
    """floor((p - q)^2 / (p + q)); p and q are at most SCALE + 1, so longs hold the square."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def shared_terms(rows: DataFrame) -> DataFrame:
    """(i, j, value), i < j: what terms that two groups share add to the sum of their single
    corrections, as partial sums."""

    def combined(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return keys, values
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys, values = keys[order], values[order]
        at = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        return keys[at], np.add.reduceat(values, at)

    def batch_of(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(values)], ["i", "j", "value"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        for t in by_runs(batches, ()):
            at = np.append(np.flatnonzero(starts(t.column(0), t.column(1))), t.num_rows)
            end = np.repeat(at[1:], np.diff(at))
            gid, p, none = (t.column(k).to_numpy() for k in (2, 3, 4))
            partners = end - np.arange(t.num_rows) - 1
            done = np.append(0, np.cumsum(partners))
            a = 0
            while a < t.num_rows:  # some rows with all their partners further down the run
                b = max(a + 1, int(np.searchsorted(done, done[a] + PAIRS, "right")) - 1)
                left = np.repeat(np.arange(a, b), partners[a:b])
                right = left + 1 + np.arange(len(left)) - np.repeat(done[a:b] - done[a], partners[a:b])
                value = _gap(p[left], p[right]) - _gap(p[left], none[right]) - _gap(none[left], p[right]) + _gap(none[left], none[right])
                new = combined(np.stack([np.minimum(gid[left], gid[right]), np.maximum(gid[left], gid[right])], 1), value)
                keys, values = combined(np.vstack([keys, new[0]]), np.concatenate([values, new[1]]))
                if len(keys) > PAIRS:
                    yield batch_of(keys, values)
                    keys, values = keys[:0], values[:0]
                a = b
        yield batch_of(keys, values)

    ordered = rows.select("lang", "term", "gid", "p", "none").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return mapped(ordered, emit, "i long, j long, value long")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, task_words: int = TASK_WORDS) -> DataFrame:
    """lang, source, part, item, value, rank: see the module's head."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    d = docs.select(blank("lang"), blank("source"), blank("text"))
    kept = materialised(kept_rows(term_rows(d.withColumn("text", F.col("text").cast("binary")), task_words), min_docs))

    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_size"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = d.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "v", "lang_size"])
    groups = materialised(groups.withColumn("gid", F.monotonically_increasing_id()).withColumn("none", probability("0", "size")))
    rows = materialised(kept.join(groups, ["lang", "source"]).withColumn("p", probability("n", "size")))
    discard(kept)

    # every two groups of a language, as if no term occurred in either
    one, other = (groups.select("lang", F.col("gid").alias(k), F.col("source").alias(f"s{k}"), F.col("none").alias(f"none_{k}"), "v") for k in ("i", "j"))
    both = one.join(other.drop("v"), "lang").where("i < j").select("lang", "i", "j", "si", "sj", F.expr(f"v * {gap('none_i', 'none_j')}").alias("base"))
    # what the terms of one group change, by the counts that differ
    levels = rows.groupBy("lang", "gid", "p", "none").agg(F.count("*").alias("m"))
    single = levels.join(other, "lang").where("gid <> j").groupBy(F.least("gid", "j").alias("i"), F.greatest("gid", "j").alias("j")).agg(F.expr(f"sum(m * ({gap('p', 'none_j')} - {gap('none', 'none_j')}))").alias("value"))
    change = single.unionByName(shared_terms(rows)).groupBy("i", "j").agg(F.sum("value").alias("change"))
    valued = both.join(change, ["i", "j"], "left").withColumn("value", F.col("base") + F.coalesce("change", F.lit(0)))
    ways = F.explode(F.array(F.struct(F.col("si").alias("source"), F.col("sj").alias("item")), F.struct(F.col("sj").alias("source"), F.col("si").alias("item"))))
    pairs = valued.select("lang", ways.alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")

    above = rows.withColumn("q", probability("total", "lang_size")).where("p > q")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))
