"""Phrase collocations: frequent words as numbers, packed n-grams counted range by range.

1. Texts of a language are read in blocks of about a megabyte.  A block numbers its own
   words in order of first use and becomes (words, counts, codes), written once.
2. The words of all blocks are summed by language; those in `min_count` places or more form
   the dictionary, numbered densely from 1.  No phrase with another word can be frequent.
3. Words of blocks meet the dictionary by an equi-join (a block asks once for each of its
   words, whatever it holds) and the answers come back by block: nothing is broadcast.
4. A block's codes become dictionary numbers, broken at other words and at the ends of
   pieces.  Each place with a frequent word after it gives one key: the numbers of three
   words in a row, 0 for a missing third, as 3 x `width` bytes.  Two words are counted by the
   prefixes of the same keys.
5. A task sorts its keys by radix and counts runs, so that a hot phrase is one key a task; the
   counted keys are cut at range borders and sent to their ranges packed.  The borders are
   quantiles of the keys of at most SAMPLE_BLOCKS_MOST blocks and steer the dealing only.
6. A range is sorted by radix again and its runs are counted.  Equal keys share a range; a
   two-word prefix that a border may cut is summed over the ranges.
7. Candidates get the counts of their parts by joins; scores are exact decimals.

Defined results: a null or empty text has no words, a null lang is `und`; repeated rows and
rows of equal or null doc_id are all counted; of cuts with equal scores the one after fewer
words counts, and ranks are total (score, count, phrase); a very long text is cut into blocks
between pieces (a single piece stays whole, in one task's memory); an empty table, or one
without frequent phrases, gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Numbers, discard, mapped, materialised, partitions_of, radix_order

MIN_COUNT, TOP = 10, 2000
SHARE = 50  # percent of a phrase's places inside a longer candidate from which it is dropped
BLOCK_BYTES = 1 << 20
TASK_KEYS = 1 << 21  # keys that a task counts before it sends them out
RANGE_KEYS = 1 << 19  # keys that are sent to a range, about
SAMPLE_BLOCKS, SAMPLE_BLOCKS_MOST, SAMPLE_STEP = 64, 1024, 64

# The characters that end a piece; tab separates words like a blank.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
FOLD = bytes(0x0A if c in BREAKS else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


# --------------------------------------------------------------------------- blocks


def stretches(data: bytes, size: int) -> Iterator[bytes]:
    """`data` in stretches of about `size` bytes, cut at line feeds only."""
    a = 0
    while a < len(data):
        b = len(data)
        if b - a > size:
            b = data.rfind(b"\n", a, a + size) + 1 or data.find(b"\n", a + size) + 1 or len(data)
        yield data[a:b]
        a = b


def blocks_of(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, lang, words, counts, wide, codes): codes are 1 + the place in `words`, 0 ends a
    piece, as integers of 16 bits (32 if `wide`)."""

    def coded(lang: str, parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for data in stretches(b"\n".join(parts).translate(FOLD), block_bytes):
            tokens = data.replace(b"\n", b" \n ").split(b" ")
            numbers = Numbers({b"": 0, b"\n": 1})
            codes = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
            words = list(numbers)[2:]
            if not words:
                continue
            codes = codes[codes > 0] - 1
            counts = np.bincount(codes, minlength=len(words) + 1)[1:]
            wide = len(words) > 0xFFFF
            packed = codes.astype("<u4" if wide else "<u2").tobytes()
            cells = [uuid.uuid4().int >> 65], [lang], [pa.array(words, pa.string())], [counts], [wide], [packed]
            kinds = pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.bool_(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cells, kinds, strict=True)], ["block", "lang", "words", "counts", "wide", "codes"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= block_bytes:
                    del sizes[lang]
                    yield from coded(lang, held.pop(lang))
            while sum(sizes.values()) > 8 * block_bytes:  # many languages: the largest goes first
                lang = max(sizes, key=sizes.__getitem__)
                del sizes[lang]
                yield from coded(lang, held.pop(lang))
        for lang in list(held):
            yield from coded(lang, held.pop(lang))

    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    return mapped(plain.where("length(text) > 0"), emit, "block long, lang string, words array<string>, counts array<long>, wide boolean, codes binary")


def dictionary(blocks: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """(lang, word, f, id) of the frequent words, ids dense from 1, and how many there are."""
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    summed = each.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    words = materialised(summed.where(F.col("f") >= min_count).withColumn("place", F.monotonically_increasing_id()))
    # one row for each task that wrote words
    tasks = sorted(words.groupBy(F.shiftright("place", 33).alias("task")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for r in tasks:
        starts.append((r["task"], total + 1))
        total += r["n"]
    starts = words.sparkSession.createDataFrame(starts, "task long, start long")
    row = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = words.withColumn("task", F.shiftright("place", 33)).join(F.broadcast(starts), "task").select("lang", "word", "f", (F.col("start") + row).alias("id"))
    dense = materialised(numbered)
    discard(words)
    return dense, total


def numbered(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """(wide, codes, ids) of blocks: the dictionary numbers of the words they hold."""
    asked = blocks.select("block", "lang", F.posexplode("words").alias("at", "word"))
    ids = asked.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("block").agg(F.collect_list(F.struct("at", "id")).alias("ids"))
    return blocks.select("block", "wide", "codes").join(ids, "block").select("wide", "codes", "ids")


# --------------------------------------------------------------------------- keys


def packed(ids: list[np.ndarray], width: int) -> np.ndarray:
    """Keys as rows of 3 x width bytes, the numbers with their high bytes first."""
    return np.hstack([x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :] for x in ids])


def unpacked(keys: np.ndarray, width: int) -> list[np.ndarray]:
    out = []
    for k in range(0, keys.shape[1], width):
        wide = np.zeros((len(keys), 8), np.uint8)
        wide[:, 8 - width :] = keys[:, k : k + width]
        out.append(wide.view(">u8").ravel().astype(np.int64))
    return out


def as_bytes(keys: np.ndarray) -> np.ndarray:
    """Rows of bytes as one column that compares like them."""
    return np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").ravel()


def counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sums of their counts: a radix sort, then runs."""
    if not len(keys):
        return keys, n
    order = radix_order(*keys.T)
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    return keys[new], np.add.reduceat(n, new)


def keys_of(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The keys of each block, in the order of its text."""
    wide, codes, ids = batch.column(0), batch.column(1), batch.column(2)
    for i in range(batch.num_rows):
        c = np.frombuffer(codes[i].as_py(), "<u4" if wide[i].as_py() else "<u2")
        have = ids[i].values
        number = np.zeros(int(c.max()) + 1, np.int64)
        number[have.field(0).to_numpy() + 1] = have.field(1).to_numpy()
        s = number[c]
        first = np.flatnonzero((s[:-1] > 0) & (s[1:] > 0))
        s = np.append(s, 0)
        yield packed([s[first], s[first + 1], s[first + 2]], width)


def counted_in_task(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, size = [], 0
    for batch in batches:
        for keys in keys_of(batch, width):
            held.append(keys)
            size += len(keys)
            if size >= TASK_KEYS:
                yield counted(np.vstack(held), np.ones(size, np.int64))
                held, size = [], 0
    if size:
        yield counted(np.vstack(held), np.ones(size, np.int64))


def borders(blocks: DataFrame, words: DataFrame, width: int, range_keys: int) -> np.ndarray:
    """First keys of the ranges after the first one, from keys of some blocks."""
    n = blocks.count()
    step = max(1, n // min(SAMPLE_BLOCKS_MOST, max(SAMPLE_BLOCKS, n // 100)))
    w, every = width, SAMPLE_STEP

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _ in counted_in_task(batches, w):
            yield pa.RecordBatch.from_arrays([pa.array([keys[every // 2 :: every].tobytes()], pa.binary()), pa.array([len(keys)], pa.int64())], ["keys", "n"])

    some = mapped(numbered(blocks.where(F.pmod("block", F.lit(step)) == 0), words), emit, "keys binary, n long").collect()
    total = sum(r["n"] for r in some) * step
    keys = np.frombuffer(b"".join(bytes(r["keys"]) for r in some), np.uint8).reshape(-1, 3 * width)
    ranges = min(-(-total // range_keys), len(keys))
    if ranges < 2:
        return np.zeros((0, 3 * width), np.uint8)
    keys = keys[radix_order(*keys.T)]
    picked = keys[np.arange(1, ranges) * len(keys) // ranges]
    return picked[np.append(True, (picked[1:] != picked[:-1]).any(axis=1))]


def dealt(blocks: DataFrame, words: DataFrame, width: int, cuts: np.ndarray) -> DataFrame:
    """(range, keys, counts): the counted keys of a task that belong to a range, packed."""
    w, first = width, as_bytes(cuts)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in counted_in_task(batches, w):
            at = np.concatenate([[0], np.searchsorted(as_bytes(keys), first), [len(keys)]])
            full = np.flatnonzero(at[1:] > at[:-1])
            n = n.astype("<u4")
            cells = [keys[at[k] : at[k + 1]].tobytes() for k in full], [n[at[k] : at[k + 1]].tobytes() for k in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *[pa.array(x, pa.binary()) for x in cells]], ["range", "keys", "counts"])

    return mapped(numbered(blocks, words), emit, "range int, keys binary, counts binary")


def frequent(sent: DataFrame, width: int, cuts: np.ndarray, min_count: int) -> DataFrame:
    """(id1, id2, id3, a): sequences of two (id3 = 0) and three words in min_count places."""
    w, split = width, np.unique(as_bytes(cuts[:, : 2 * width]))

    def tally(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return counted(np.vstack(keys), np.concatenate(n))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, size, most = [], [], 0, 4 * TASK_KEYS
        for batch in batches:
            for k, c in zip(batch.column(1), batch.column(2), strict=True):
                keys.append(np.frombuffer(k.as_buffer(), np.uint8).reshape(-1, 3 * w))
                n.append(np.frombuffer(c.as_buffer(), "<u4").astype(np.int64))
                size += len(n[-1])
                if size > most:
                    keys, n = ([x] for x in tally(keys, n))
                    size = len(n[0])
                    most = max(most, 2 * size)
        if not size:
            return
        k, c = tally(keys, n)
        del keys, n
        two = np.flatnonzero(np.append(True, (k[1:, : 2 * w] != k[:-1, : 2 * w]).any(axis=1)))
        pairs, sums = k[two].copy(), np.add.reduceat(c, two)
        pairs[:, 2 * w :] = 0
        open_ = np.isin(as_bytes(pairs[:, : 2 * w]), split)
        on, whole = open_ | (sums >= min_count), (k[:, 2 * w :] > 0).any(axis=1) & (c >= min_count)
        ids = unpacked(np.vstack([pairs[on], k[whole]]), w)
        more = np.concatenate([sums[on], c[whole]]), np.concatenate([open_[on], np.zeros(int(whole.sum()), bool)])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*ids, *more)], ["id1", "id2", "id3", "a", "open"])

    found = materialised(mapped(sent.repartitionById(len(cuts) + 1, F.col("range")), emit, "id1 long, id2 long, id3 long, a long, open boolean"))
    summed = found.where("open").groupBy("id1", "id2", "id3").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)
    return found.where("NOT open").drop("open").unionByName(summed)


# --------------------------------------------------------------------------- scores


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)); decimals of 38 digits hold a up to 10^15."""
    wide = "CAST({} AS DECIMAL(18, 0))".format
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * CAST({wide(a)} * {wide(a)} AS DECIMAL(31, 0))) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, share: int = SHARE, block_bytes: int = BLOCK_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases of two and
    three words; `share`: see SHARE."""
    blocks = materialised(blocks_of(docs, block_bytes))
    sizes = materialised(blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n")))
    words, total = dictionary(blocks, min_count)
    width = max(1, (total.bit_length() + 7) // 8)
    cuts = borders(blocks, words, width, range_keys)
    grams = materialised(frequent(dealt(blocks, words, width, cuts), width, cuts, min_count))
    discard(blocks)

    named = lambda k: words.select(F.col("id").alias(f"id{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"), *([F.col("lang")] if k == 1 else []))
    pairs = grams.where("id3 = 0").select("id1", "id2", "a")
    longer = grams.where("id3 > 0").select("id1", "id2", "id3", F.col("a").alias("longer"))
    within = longer.select("id1", "id2", "longer").union(longer.select("id2", "id3", "longer")).groupBy("id1", "id2").agg(F.max("longer").alias("longer"))
    two = pairs.join(within, ["id1", "id2"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    two = two.join(named(1), "id1").join(named(2), "id2").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("a", "f1", "f2").alias("score"))

    three = longer.withColumnRenamed("longer", "a").join(pairs.withColumnRenamed("a", "f12"), ["id1", "id2"]).join(pairs.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("a").alias("f23")), ["id2", "id3"])
    three = three.join(named(1), "id1").join(named(2), "id2").join(named(3), "id3").withColumn("s1", score("a", "f1", "f23")).withColumn("s2", score("a", "f12", "f3"))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))

    # a language may hold most phrases: first the best of each of its parts, then of all
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(partitions_of(docs)))
    firsts = two.unionByName(three).withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
