"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Documents are sets of distinct word 4-grams (64-bit hashes).  Equal sets collapse to one
class first, so copies are never paired.  In a fixed order of n-grams (frequent ones last),
two sets of likeness 0.85 or more share an n-gram of their prefixes, and their sizes lie in
the same or adjacent bands; so candidates meet in *tiles*, one for each prefix n-gram and
size band.

1. Star step: in the tiles of the first few prefix n-grams each class is tried against the
   tile's least doc_id only; links found make components.
2. Contested tiles: of all prefix tiles only those that still hold two components matter.
   Within them, classes of different components pair up if their sizes allow it and the
   bitmaps leave room: the bits that one set has and the other lacks bound the overlap from
   above.  Star steps towards each tile's least component come first, again as long as they
   find links, so that a large group of near copies is a star and not all its pairs.
3. Every candidate is decided by intersecting the two exact sorted arrays.

The list of frequent n-grams comes from a bounded sample and has a bounded length; it only
fixes the order and can't change the result.  Where the sample has missed some, so that tiles
of over CROWDED sets are contested, their n-grams (counted exactly) join the list, and the
prefixes are taken anew: sets that share a passage, but little else, then meet no more.  Tiles
that stay crowded after two such rounds, of sets that hardly have other n-grams, are still
starred and paired whole.

Equality of sets and n-grams is that of 64-bit hashes.

Defined results: words are compared with A-Z lower-cased; fewer than four words make one
shingle of them all; a null text or one without words has no shingles and no links; rows of
equal doc_id share their component (each of their texts is held against others, and what they
link to is one component); the least doc_id names a component; repeated rows and very long texts need no
care; rows without a doc_id are left out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U, Chunk, checkpointed, chunks, discard, id_and_text, mapped, materialised, mix, numbered_texts, prefix, ragged, rooted, span, to_long, words_of

SHINGLE, PERCENT = 4, 85
MAX_BITS = 1 << 18
FIRST = 3  # prefix n-grams of the first star step
SAMPLE_DOCS, FREQUENT, MAX_FREQUENT = 20_000, 10, 200_000
MAX_BROADCAST = 500_000  # pairs whose ids are broadcast
CROWDED = 2_000  # sets of several components that have an n-gram in their prefixes, beyond which it is put last
MAX_CROWDED = 500_000  # n-grams put last in a round (four megabytes), those of most sets first
ORDER_ROUNDS = 2
EARLIER = 8  # n-grams before a row's own that it carries: sets that share many mostly share one of these
LARGE = 128  # rows of a tile beyond which they carry their bitmaps
MANY = 50  # pairs a class in contested tiles, beyond which another star step comes first


def shingles(c: Chunk, width: int) -> list[np.ndarray]:
    """For each document its distinct shingle hashes in ascending order."""
    low = c.data.copy()
    low[(low >= 65) & (low <= 90)] += 32
    w = words_of(c)
    sums = prefix(w.hashes(low))
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= width:
            i = np.arange(a, b - width + 1)
            out.append(np.unique(span(sums, i, i + width)))
        elif b > a:
            out.append(span(sums, np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, U))
    return out


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set it links to."""
    return -(-percent * n // 100)


def profile(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, n, whole (hash of the set), tokens (prefix in the fixed order), bits."""
    frequent = np.sort(frequent)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                sets = shingles(c, width)
                n = np.array([len(x) for x in sets], np.int64)
                flat = np.concatenate(sets)
                doc = np.repeat(np.arange(len(c)), n)
                late = among_sorted(flat, frequent)
                # in the fixed order: frequent ones last, by hash within
                order = np.lexsort((flat, late, doc))
                start = np.cumsum(n) - n
                place = np.arange(len(flat)) - np.repeat(start, n)
                size = np.where(n > 0, n + percent * n // -100 + 1, 0)  # n - least overlap + 1
                lead = place < np.repeat(size, n)
                code = mix(flat.copy())
                whole = np.zeros(len(c), U)
                np.add.at(whole, doc, code)
                # a bitmap of four bits or more for each shingle, its size a power of two
                wide = np.minimum(np.maximum(1 << np.ceil(np.log2(np.maximum(4 * n, 1))).astype(np.int64), 64), MAX_BITS)
                base = np.cumsum(wide) - wide
                bits = np.zeros(int(wide.sum()), np.uint8)
                bits[base[doc] + (code & (wide[doc] - 1).astype(U)).astype(np.int64)] = 1
                words = np.packbits(bits).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.ids, pa.int64()), pa.array(n), pa.array(to_long(whole)), ragged(to_long(flat[order][lead]), size, pa.int64()), ragged(words, wide // 64, pa.int64())],
                    ["doc_id", "n", "whole", "tokens", "bits"],
                )

    return mapped(docs, emit, "doc_id long, n long, whole long, tokens array<long>, bits array<long>")


def among_sorted(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    total = docs.count()
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(7)), 11).cast("double") * F.lit(2.0**-53)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                sets = shingles(c, width)
                yield pa.RecordBatch.from_arrays([pa.array(to_long(np.concatenate(sets)))], ["token"])

    rows = mapped(docs.where(u < SAMPLE_DOCS / max(total, 1)), emit, "token long")
    top = rows.groupBy("token").count().where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "token").limit(MAX_FREQUENT)
    return np.array([r["token"] for r in top.collect()], np.int64).view(U)


def holders(reps: DataFrame, some: np.ndarray) -> DataFrame:
    """doc_id of the sets that have one of `some` in their prefixes."""
    some = np.sort(some)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            hit = np.cumsum(np.append(0, among_sorted(lists.flatten().to_numpy(zero_copy_only=False).view(U), some)))
            ends = np.cumsum(np.append(0, lists.value_lengths().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit[ends[1:]] > hit[ends[:-1]]))], ["doc_id"])

    return mapped(reps.select("doc_id", "tokens"), emit, "doc_id long")


def band(n: str, percent: int) -> Column:
    """Sizes of linked sets lie in the same band or in adjacent ones."""
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(float(np.log(100 / percent)) * 1.000001)).cast("int")


def linked(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact sets link.

    Only the texts of documents in pairs are shuffled: their ids are broadcast if they are
    few, by a count, and joined otherwise.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    few = pairs.count() <= MAX_BROADCAST
    docs = docs.join(F.broadcast(ids) if few else ids.hint("shuffle_hash"), "doc_id", "left_semi")
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def sets_of(column: pa.Array, ids: pa.Array, known: dict) -> list[np.ndarray]:
        new = {}
        for i, k in enumerate(ids.to_pylist()):
            if k not in known and k not in new:
                new[k] = i
        part = pa.RecordBatch.from_arrays([ids.take(pa.array(list(new.values()), pa.int64())), column.take(pa.array(list(new.values()), pa.int64()))], ["doc_id", "text"])
        for c in chunks(part):
            known.update(zip(c.ids.tolist(), shingles(c, width), strict=True))
        return [known[k] for k in ids.to_pylist()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                col = lambda name: part.column(part.schema.get_field_index(name))  # noqa: E731, B023
                known: dict = {}
                a, b = sets_of(col("text_a"), col("a"), known), sets_of(col("text_b"), col("b"), known)
                ok = []
                for x, y in zip(a, b, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True)) if least_overlap(len(x), percent) <= len(y) and least_overlap(len(y), percent) <= len(x) else 0
                    ok.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
                keep = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([col("a").filter(keep), col("b").filter(keep)], ["a", "b"])

    return mapped(both, emit, "a long, b long")


def room(a: str, b: str, percent: int) -> Column:
    """Whether sizes and bitmaps of rows `a` and `b` leave room for a link.

    Each bit that only one set has stands for a shingle that the other lacks.  Sizes of sets
    that may link differ by less than a factor of two, so a larger bitmap is folded once.
    """

    def folded(x: Column, y: Column) -> Column:
        half = F.size(y)
        return F.when(F.size(x) > half, F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseOR(q))).otherwise(x)

    lacks = lambda x, y: F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, v: s + v)
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    ba, bb = F.col(f"{a}.bits"), F.col(f"{b}.bits")
    most = F.least(na - lacks(ba, bb), nb - lacks(bb, ba))
    sizes = (na * 100 >= nb * percent) & (nb * 100 >= na * percent)
    return F.when(sizes, most * 100 >= (na + nb - most) * percent).otherwise(F.lit(False))


def jaccard_components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, star_rounds: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of `docs`."""
    docs = id_and_text(docs)
    apart = numbered_texts(docs)
    if apart is None:
        return set_components(docs, width, percent, star_rounds)
    # every text takes part on its own; components that share a doc_id are one
    texts, rows = apart
    own = materialised(rows.join(set_components(texts, width, percent, star_rounds).withColumnRenamed("doc_id", "row_id"), "row_id"))
    least = own.groupBy("doc_id").agg(F.min("component_id").alias("a"))
    shared = rooted(own.join(least, "doc_id").select("a", F.col("component_id").alias("b")))
    whole = own.join(shared.withColumnRenamed("node", "component_id"), "component_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "component_id").alias("whole"))
    named = whole.groupBy("whole").agg(F.min("doc_id").alias("component_id"))
    return whole.join(named, "whole").select("doc_id", "n_shingles", "component_id")


def set_components(docs: DataFrame, width: int, percent: int, star_rounds: int) -> DataFrame:
    """The same for rows of which equal doc_ids have equal texts."""
    frequent = frequent_shingles(docs, width)
    seen = materialised(profile(docs, width, percent, frequent))
    some = seen.where("n > 0")
    classes = some.groupBy("whole", "n").agg(F.min("doc_id").alias("rep"))
    reps = materialised(some.join(classes.withColumnRenamed("rep", "doc_id"), ["whole", "n", "doc_id"]).dropDuplicates(["doc_id"]).select("doc_id", "n", "whole", "tokens", "bits").withColumn("band", band("n", percent)))

    # 1. star step over the first tokens
    short = reps.select("doc_id", "band", F.explode(F.slice("tokens", 1, FIRST)).alias("token"))
    hubs = short.groupBy("token", "band").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("top")).where("hub < top")
    pairs = short.join(hubs, ["token", "band"]).where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    tried = materialised(pairs)
    links = materialised(linked(materialised(with_room(tried, reps, percent)), docs, width, percent))

    # 2. contested tiles; they only become fewer as components merge
    comp = rooted(links).withColumnRenamed("node", "doc_id")
    for r in range(ORDER_ROUNDS + 1):
        rows = reps.join(comp, "doc_id", "left").select("doc_id", "band", F.coalesce("component", "doc_id").alias("comp"), "n", F.posexplode("tokens").alias("pos", "token"))
        # shingles of the set from this one on in the fixed order: if it is the first that two sets
        # share, they share no more than that
        rows = rows.withColumn("left", F.col("n") - F.col("pos"))
        contested = materialised(rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size")).where("low < high").select("token", "size"))
        # n-grams of crowded tiles are put last, and prefixes taken in the new order
        crowded = contested.where(F.col("size") > CROWDED).orderBy(F.desc("size"), "token").limit(MAX_CROWDED)
        late = np.setdiff1d(np.array([x["token"] for x in crowded.collect()], np.int64).view(U), frequent) if r < ORDER_ROUNDS else np.zeros(0, U)
        if not len(late):
            break
        frequent = np.concatenate([frequent, late])
        # the other prefixes hold none of these, and so are the same in the new order
        moved = materialised(holders(reps, late))
        moved_ = F.broadcast(moved) if moved.count() <= MAX_BROADCAST else moved.hint("shuffle_hash")
        again = profile(docs.join(moved_, "doc_id", "left_semi"), width, percent, frequent).dropDuplicates(["doc_id", "whole", "n"])
        again = reps.select("doc_id", "whole", "n", "band").join(again, ["doc_id", "whole", "n"]).select(*reps.columns)
        reps = reps.join(moved_, "doc_id", "left_anti").union(materialised(again))
        discard(contested)
    held = rows.join(contested.select("token"), "token").select("doc_id", "token", "band", "comp", "n", "left")
    # a set is in the tiles of its own band and of the one below
    held = materialised(held.select("doc_id", "token", "comp", "n", "left", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("tile")))
    for r in range(star_rounds + 1):
        before = held
        size = held.groupBy("token", "tile").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size")).where("low < high")
        held = materialised(held.join(size.select("token", "tile", "low", "size"), ["token", "tile"]))
        discard(before)
        ahead = held.agg(F.sum("size"), F.countDistinct("doc_id")).first()
        if r == star_rounds or (ahead[0] or 0) <= MANY * max(ahead[1], 1):
            break
        # the tile's least component against the least class of each other component
        heads = held.groupBy("token", "tile", "comp").agg(F.min("doc_id").alias("doc_id"), F.min("low").alias("low"))
        hub = heads.where("comp = low").select("token", "tile", F.col("doc_id").alias("b"))
        fresh = heads.where("comp > low").join(hub, ["token", "tile"]).select(F.col("doc_id").alias("a"), "b").distinct()
        fresh = materialised(fresh.join(tried, ["a", "b"], "left_anti"))
        found = materialised(linked(materialised(with_room(fresh, reps, percent)), docs, width, percent))
        tried = tried.union(fresh)
        if found.isEmpty():
            break
        links = materialised(links.union(found))
        comp = rooted(links).withColumnRenamed("node", "doc_id")
        held = held.select("doc_id", "token", "tile", "n", "left").join(comp, "doc_id", "left").select("doc_id", "token", "tile", "n", "left", F.coalesce("component", "doc_id").alias("comp"))

    # 3. all remaining pairs of different components within contested tiles.  Two sets that share
    # several n-grams meet in the tile of the first of them only, as far as each row knows the
    # n-grams before its own.  Rows of large tiles carry the bitmaps, so that only pairs with room
    # are made there; in small ones a set has few partners
    ahead_of = Window.partitionBy("doc_id", "tile").orderBy(F.desc("left")).rowsBetween(-EARLIER, -1)
    rows = held.repartition("doc_id").select("doc_id", "token", "tile", "comp", "n", "left", "size", F.collect_list("token").over(ahead_of).alias("earlier"))
    rows = rows.join(reps.select("doc_id", "bits"), "doc_id").withColumn("bits", F.when(F.col("size") > LARGE, F.col("bits")))
    meet = (F.col("a.token") == F.col("b.token")) & (F.col("a.tile") == F.col("b.tile")) & (F.col("a.doc_id") > F.col("b.doc_id")) & (F.col("a.comp") != F.col("b.comp"))
    fits = (F.col("a.n") * 100 >= F.col("b.n") * percent) & (F.col("b.n") * 100 >= F.col("a.n") * percent)
    ahead = F.least("a.left", "b.left") * (100 + percent) >= (F.col("a.n") + F.col("b.n")) * percent
    may = meet & fits & ahead & ~F.arrays_overlap("a.earlier", "b.earlier") & (F.col("a.bits").isNull() | room("a", "b", percent))
    rest = rows.alias("a").join(rows.alias("b"), may).select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b"))
    rest = rest.distinct().join(tried, ["a", "b"], "left_anti")
    rest = materialised(with_room(rest, reps, percent))
    links = checkpointed(links.union(linked(rest, docs, width, percent)))
    discard(held, rest, tried, reps, contested)  # what follows reads the profiles and the links alone

    comp = rooted(links)
    named = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("whole", "n", F.coalesce("component", "rep").alias("component_id"))
    out = seen.select("doc_id", "n", "whole").join(named, ["whole", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def with_room(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and bitmaps leave room for a link."""
    has = reps.select("doc_id", "n", "bits")
    a, b = has.alias("x"), has.alias("y")
    both = pairs.join(a, F.col("a") == F.col("x.doc_id")).join(b, F.col("b") == F.col("y.doc_id"))
    return both.where(room("x", "y", percent)).select("a", "b")
