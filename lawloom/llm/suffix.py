"""Suffix-array dedup of byte strings: two-stage sorting, shard by shard.

Whole texts can't be put into one suffix array at scale, so Spark first brings together
what can be equal:

1. Every 100-byte window is spoken for by the least hash of the 32-byte strings inside it
   (the same one wherever the window recurs).  Adjacent windows with the same such key form
   a *run*, a stretch of text of about 135 bytes; one run starts about every 35 bytes.
2. Runs are dealt by key.  A run that also lies in a smaller document is repeated as a whole.
   Runs whose key no other run has are unique.  What remains *open* is the first copy of
   each of several different runs around one key: the ends of repeated passages.
3. The open runs' bytes are dealt to shards by key.  Each shard sorts its suffixes in two
   stages: those smaller than their successors directly, all others induced by scanning the
   buckets in order; then adjacent common prefixes are computed, and windows that share
   100 bytes or more with their neighbours form classes, which keep their first document.
4. Each document's removed stretches meet its text.  Repeats within a document are found
   there, by the same two-stage suffix array over what lies around the short strings that
   recur in the document, many documents at a time.

Very frequent keys (a list of bounded length, from a bounded sample of documents; it only
steers the work) are dealt by key and run.  Their open runs are split by where the short
string lies in the window, and dealt by the 84 or more bytes that a part's windows share; a
part whose shared bytes are frequent too is dealt window by window.  So no group that grows
with the corpus meets in one task.

Defined results: a null or empty text has no bytes; strings never cross documents; rows of
equal doc_id and text do not count as earlier than each other (they are cut alike); of different
texts under one doc_id that of the lesser SHA-256 is the earlier document; of equal strings within
a document the first stays; a very long text is a chunk of its own; rows without a doc_id are left out;
extra columns are ignored.  Whole runs and the windows of very frequent parts are compared by
64-bit hashes, all others byte by byte.  Cutting may leave bytes that aren't valid UTF-8, so the kept
text is binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, U, Chunk, chunks, id_and_text, mapped, materialised, mix, numbered_texts, owner, partitions_of, prefix, sliding_min, span, to_long

LENGTH = 100
ANCHOR = 32
SAMPLE_DOCS = 5_000  # documents from which frequent keys are taken
FREQUENT = 20  # documents of the sample that make a key frequent
MAX_FREQUENT = 50_000  # keys in the list
SHARD_BYTES = 1 << 20


# ------------------------------------------------------------ two-stage suffix sorting


def words8(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number (zeros past the end)."""
    t = np.concatenate([text, np.zeros(8, np.uint8)]).astype(U)
    n, out = len(text), np.zeros(len(text), U)
    for k in range(8):
        out |= t[k : k + n] << U(56 - 8 * k)
    return out


def word_ranks(text: np.ndarray) -> np.ndarray:
    """Rank of the eight bytes from each position among all of them, equal if they are."""
    key = words8(text)
    order = np.argsort(key)
    ordered = key[order]
    out = np.empty(len(key), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return out


def sort_directly(at: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes `at` in order of their first `depth` bytes: eight bytes at a time, and only
    those that are still tied take part in the next step."""
    n = len(word)
    if not len(at):
        return at
    order = at[np.argsort(word[at])]
    first = word[order]
    rank = np.concatenate([[0], np.cumsum(first[1:] != first[:-1])])
    where = np.arange(len(order))
    for k in range(8, depth, 8):
        same = rank[1:] == rank[:-1]
        tied = np.append(False, same) | np.append(same, False)
        where, rank = where[tied], rank[tied]
        if not len(where):
            break
        far = order[where] + k
        both = (rank << 32) | np.where(far < n, word[np.minimum(far, n - 1)] + 1, 0)
        by = np.argsort(both)
        order[where] = order[where][by]
        both = both[by]
        rank = np.cumsum(np.append(True, both[1:] != both[:-1]))
    return order


def suffix_array(text: np.ndarray, depth: int = LENGTH, word: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of `text` (bytes) in order of at least their first `depth` bytes."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    # a suffix is smaller than its successor if the first differing neighbour byte is larger;
    # the last suffix is larger than the empty one
    nxt = np.append(text[1:], 0).astype(np.int16)
    sign = np.sign(nxt - text.astype(np.int16))
    sign[-1] = -1
    change = np.flatnonzero(sign)
    small = np.repeat(sign[change], np.diff(change, prepend=-1)) > 0
    ordered = sort_directly(np.flatnonzero(small), word_ranks(text) if word is None else word, depth + 8)
    head = text[ordered]
    cut = np.searchsorted(head, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))  # its successor, the empty suffix, is the first of all
    out = []
    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        scanned = []
        while len(wave):  # larger suffixes whose successor lies in this bucket too come in waves
            scanned.append(wave)
            prev = wave[wave > 0] - 1
            wave = prev[text[prev] == c]
        bucket = np.concatenate([*scanned, ordered[cut[c] : cut[c + 1]]])
        out.append(bucket)
        prev = bucket[bucket > 0] - 1
        prev = prev[(text[prev] > c)]
        if len(prev):
            by = np.argsort(text[prev], kind="stable")
            prev = prev[by]
            firsts = text[prev]
            edges = np.flatnonzero(np.append(True, firsts[1:] != firsts[:-1]))
            for a, b in zip(edges, [*edges[1:], len(prev)], strict=True):
                waiting[firsts[a]].append(prev[a:b])
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int = LENGTH, word: np.ndarray | None = None) -> np.ndarray:
    """Common prefix of each suffix with the one before it in `sa`, up to `most` bytes."""
    n, out = len(text), np.zeros(len(sa), np.int64)
    raw = np.append(words8(text), U(0))
    word = np.append(word_ranks(text) if word is None else word, -1)
    alive = np.arange(1, len(sa))
    k = 0
    while k < most and len(alive):
        here, there = np.minimum(sa[alive] + k, n), np.minimum(sa[alive - 1] + k, n)
        same = word[here] == word[there]
        apart = raw[here[~same]] ^ raw[there[~same]]
        for j in range(8):  # the last, partial step: leading bytes that are equal
            out[alive[~same]] += apart < U(1) << U(56 - 8 * j)
        alive = alive[same]
        out[alive] += 8
        k += 8
    room = n - np.maximum(sa[1:], sa[:-1])
    out[1:] = np.minimum(np.minimum(out[1:], room), most)
    return out


def repeat_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, class of each): suffixes of a class share their first `length` bytes."""
    word = word_ranks(text)
    sa = suffix_array(text, length, word)
    return sa, np.cumsum(common_prefixes(text, sa, length, word) < length)


# ------------------------------------------------------------ runs


def found_twice(x: np.ndarray) -> np.ndarray:
    """Which values are also found elsewhere in `x`."""
    order = np.argsort(x)
    same = x[order][1:] == x[order][:-1]
    out = np.zeros(len(x), bool)
    out[order] = np.append(False, same) | np.append(same, False)
    return out


def window_keys(c: Chunk, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(sums, h, key, valid): the hashes of the short strings, the least of them in each window,
    and which windows end within their document."""
    sums = prefix(BYTE_CODE[c.data])
    i = np.arange(len(c.data) - anchor + 1)
    h = span(sums, i, i + anchor)
    key = sliding_min(h, length - anchor + 1)
    valid = np.arange(len(key)) + length <= np.repeat(c.offsets[1:], np.diff(c.offsets))[: len(key)]
    return sums, h, key, valid


def recurring(c: Chunk, length: int, anchor: int, sums: np.ndarray, h: np.ndarray, key: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, doc) of the short strings around which a window may recur in its own document.

    Such a string is the least one of some window that holds it, and lies at the same place in
    the other copy; so one of a few strings of about 84 bytes around it (`segments` has the
    same) recurs with it."""
    wide = length - anchor + 1
    held = ~sliding_min(~np.concatenate([np.zeros(wide - 1, U), np.where(valid, key, U(0)), np.zeros(len(h) - len(key), U)]), wide)
    place = np.flatnonzero(held == h)
    doc = np.searchsorted(c.offsets, place, "right") - 1
    twice = found_twice(h[place] ^ mix(doc.astype(U) + U(1)))
    place, doc = place[twice], doc[twice]
    free = length - anchor
    step = max(free // 4, 1)
    keep = np.zeros(len(place), bool)
    for left in range(0, free + 1, step):
        a, b = place - left, place + anchor + max(free - left - step + 1, 0)
        inside = np.flatnonzero((a >= c.offsets[doc]) & (b <= c.offsets[doc + 1]))
        both = span(sums, a[inside], b[inside]) ^ mix(doc[inside].astype(U) + U(1))
        keep[inside] |= found_twice(both)
    return place[keep], doc[keep]


def runs_of(c: Chunk, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(doc, at, n, key, run, within) of each run: first window, number of windows, key and
    hash of the bytes; `at` counts from the chunk's first byte.  within: the documents in
    which a window may recur."""
    z = np.zeros(0, np.int64)
    sizes = np.diff(c.offsets)
    if not (sizes >= length).any():
        return z, z, z, z.view(U), z.view(U), z
    sums, h, key, valid = window_keys(c, length, anchor)
    last = np.repeat(c.offsets[1:], sizes)[: len(key)]
    new = np.empty(len(key), bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    new[1:] |= ~valid[:-1]
    starts = c.offsets[:-1][sizes >= length]
    new[starts] = True
    new &= valid
    at = np.flatnonzero(new)
    stop = np.append(at[1:], len(key))
    end = np.minimum(stop, last[at] - length + 1)  # windows end with the document
    doc = np.searchsorted(c.offsets, at, "right") - 1
    within = np.unique(recurring(c, length, anchor, sums, h, key, valid)[1])
    return doc, at, end - at, key[at], span(sums, at, end + length - 1), within


ROW = "kind byte, doc_id long, key long, run long, at int, n int"
FRESH, REPEATED, OPEN, WITHIN, OFTEN = 0, 1, 2, 3, 4
NAMES = ["kind", "doc_id", "key", "run", "at", "n"]
# rows that only pass through are dealt by document, those of frequent keys by key and run
DEALT = f"CASE WHEN kind IN ({REPEATED}, {WITHIN}) THEN doc_id WHEN kind = {OFTEN} THEN key ^ run ELSE key END"


def first_of(key: np.ndarray, run: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row, the least doc of its (key, run)."""
    by = np.lexsort((doc, run, key))
    k, r = key[by], run[by]
    new = np.ones(len(by), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    out = np.empty(len(by), doc.dtype)
    out[by] = doc[by][np.flatnonzero(new)[np.cumsum(new) - 1]]
    return out


def once_a_document(at: np.ndarray, *by: np.ndarray) -> np.ndarray:
    """Index of the row of the least `at` of each combination of `by` (the documents among them).
    What recurs within a document is found there, so only its first place is held against
    other documents."""
    order = np.lexsort((at, *by))
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in by], axis=0)
    return np.sort(order[new])


def run_rows(docs: DataFrame, length: int, anchor: int, frequent: np.ndarray) -> DataFrame:
    """A row for each different run of a document.  Runs that a batch itself shows to be
    repeated are marked at once and dealt by document; the others are dealt by key, or by key
    and run if it is frequent."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: list[list[np.ndarray]] = []
            within: list[np.ndarray] = []
            for c in chunks(batch):
                doc, at, n, key, run, twice = runs_of(c, length, anchor)
                got.append([c.ids[doc], at - c.offsets[doc], n, key, run])
                within.append(c.ids[twice])
            if not got:
                continue
            ids, at, n, key, run = (np.concatenate(x) for x in zip(*got, strict=True))
            some = once_a_document(at, run, key, ids)
            ids, at, n, key, run = (x[some] for x in (ids, at, n, key, run))
            late = ids > first_of(key, run, ids)
            kind = np.where(late, REPEATED, np.where(np.isin(key, frequent), OFTEN, FRESH))
            key, run = np.where(late, U(0), key), np.where(late, U(0), run)
            own = np.concatenate(within)
            zero = np.zeros(len(own), np.int64)
            columns = [np.concatenate(x) for x in ((kind, zero + WITHIN), (ids, own), (to_long(key), zero), (to_long(run), zero), (at, zero), (n, zero))]
            yield pa.RecordBatch.from_arrays([pa.array(x).cast(t) for x, t in zip(columns, (pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], NAMES)

    return mapped(docs, emit, ROW)


def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order of key, run and document become repeated, open, or nothing; other rows
    pass through.  Between batches only the last key is remembered: its last run with the
    least document, whether it has several runs, and, while it has one, the first copies."""
    last: tuple[int, int, int, bool] | None = None
    waiting: list[tuple] = []  # first copies of the last key's only run

    def rows(kind: int, doc, key, at, n, often) -> pa.RecordBatch:
        kinds = (pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        values = (np.full(len(doc), kind), doc, key, at, n, often)
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x).astype(t.to_pandas_dtype()), t) for x, t in zip(values, kinds, strict=True)], ["kind", "doc_id", "key", "at", "n", "often"])

    for batch in batches:
        kind, doc, key, run, at, n = (batch.column(batch.schema.get_field_index(x)).to_numpy(zero_copy_only=False) for x in NAMES)
        for k in (REPEATED, WITHIN):
            some = kind == k
            if some.any():
                yield rows(k, doc[some], key[some], at[some], n[some], np.zeros(int(some.sum()), bool))
        some = (kind == FRESH) | (kind == OFTEN)
        if not some.any():
            continue
        often, doc, key, run, at, n = (x[some] for x in (kind == OFTEN, doc, key, run, at, n))
        # the remembered run leads, so that its copies here find its first document
        lead = last or (key[0], run[0], doc[0], False)
        k, r, d = (np.append(np.array([x], np.int64), y) for x, y in zip(lead[:3], (key, run, doc), strict=True))
        new_key = np.append(True, k[1:] != k[:-1])
        new_run = new_key | np.append(True, r[1:] != r[:-1])
        first = d[new_run][np.cumsum(new_run) - 1]
        group = np.cumsum(new_key) - 1
        mixed = np.bincount(group, new_run) > 1
        mixed[0] |= lead[3]
        late = d > first
        open_ = ~late & (mixed[group] | np.append(False, often))
        if waiting and mixed[0]:
            yield rows(OPEN, *(np.array(x) for x in zip(*waiting, strict=True)))
        if mixed[0] or group[-1] > 0:
            waiting = []
        yield rows(REPEATED, doc[late[1:]], key[late[1:]], at[late[1:]], n[late[1:]], often[late[1:]])
        some = open_[1:]
        yield rows(OPEN, doc[some], key[some], at[some], n[some], often[some])
        if not mixed[-1]:
            some = (~late & ~open_ & (group == group[-1]))[1:]
            waiting += zip(*(x[some].tolist() for x in (doc, key, at, n, often)), strict=True)
        last = (k[-1], r[-1], first[-1], bool(mixed[-1]))


def frequent_keys(docs: DataFrame, length: int, anchor: int) -> np.ndarray:
    """Keys of many documents of the sample.  The list only decides how rows are dealt, never
    what is removed."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                doc, _, _, key, _, _ = runs_of(c, length, anchor)
                some = np.unique(key ^ mix(doc.astype(U) + U(1)), return_index=True)[1]
                yield pa.RecordBatch.from_arrays([pa.array(to_long(key[some]))], ["key"])

    return top_keys(mapped(sampled(docs), emit, "key long"))


def sampled(docs: DataFrame) -> DataFrame:
    """About SAMPLE_DOCS documents, chosen by a hash of the id."""
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11).cast("double") * F.lit(2.0**-53)
    return docs.where(u < SAMPLE_DOCS / max(docs.count(), 1))


def top_keys(rows: DataFrame) -> np.ndarray:
    top = rows.groupBy("key").count().where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "key").limit(MAX_FREQUENT)
    return np.array([r["key"] for r in top.collect()], np.int64).view(U)


# ------------------------------------------------------------ open runs


def segments(part: bytes, n: int, key: U, length: int, anchor: int, steps: int = 4) -> tuple[np.ndarray, ...]:
    """(first window, end, subkey) of the parts of a run: windows in which the short string
    of hash `key` lies in the same quarter; the subkey is the hash of the bytes they share."""
    sums = prefix(BYTE_CODE[np.frombuffer(part, np.uint8)])
    i = np.arange(len(part) - anchor + 1)
    place = np.flatnonzero(span(sums, i, i + anchor) == key)
    win = np.arange(n)
    at = place[np.minimum(np.searchsorted(place, win), len(place) - 1)]
    free = length - anchor
    wide = free // steps
    quarter = (at - win) // wide
    a = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (quarter[1:] != quarter[:-1])))
    b = np.append(a[1:], n)
    left = quarter[a] * wide
    right = np.maximum(free - np.minimum(left + wide - 1, free), 0)
    return a, b, mix(span(sums, at[a] - left, at[a] + anchor + right) + quarter[a].astype(U))


def frequent_parts(docs: DataFrame, length: int, anchor: int, frequent: np.ndarray) -> np.ndarray:
    """Subkeys of many documents of the same sample, among the runs of frequent keys."""
    if not len(frequent):
        return frequent

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                doc, at, n, key, _, _ = runs_of(c, length, anchor)
                found: dict[int, set] = {}
                for k in np.flatnonzero(np.isin(key, frequent)):
                    subs = segments(c.data[at[k] : at[k] + n[k] + length - 1].tobytes(), n[k], key[k], length, anchor)[2]
                    found.setdefault(int(doc[k]), set()).update(to_long(subs).tolist())
                yield pa.RecordBatch.from_arrays([pa.array([x for v in found.values() for x in v], pa.int64())], ["key"])

    return top_keys(mapped(sampled(docs), emit, "key long"))


def stretches(d: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, first, number) of the runs of adjacent windows among windows (d, a)."""
    by = np.lexsort((a, d))
    d, a = d[by], a[by]
    new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (a[1:] > a[:-1] + 1))) if len(d) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(d))[: len(new)] - 1
    return d[new], a[new], a[last] - a[new] + 1


def open_bytes(told: DataFrame, length: int, anchor: int, parts: np.ndarray) -> DataFrame:
    """(kind, doc_id, key, at, n, bytes) of the open runs listed with each document.  A frequent
    key's run gives its parts by subkey; a part whose subkey is in `parts` gives a row for each
    different window, keyed by its hash and without bytes.  Windows that a batch itself shows to
    be repeated are marked at once, adjacent ones in one row."""

    parts = np.append(np.sort(parts), U(0))  # the last is looked at beyond the others and equals none

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            lists = batch.column(batch.schema.get_field_index("open"))
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            runs: list[tuple] = []
            wins: list[tuple] = []
            for i, doc in enumerate(ids):
                data = (texts[i].as_py() or "").encode()
                for o in lists[i].as_py():
                    a, n = o["at"], o["n"]
                    part = data[a : a + n + length - 1]
                    if not o["often"]:
                        runs.append((doc, o["key"], a, n, part))
                        continue
                    first, stop, sub = segments(part, n, np.array([o["key"]]).view(U)[0], length, anchor)
                    for x, y, key, hot in zip(first.tolist(), stop.tolist(), to_long(sub).tolist(), (parts[np.searchsorted(parts[:-1], sub)] == sub).tolist(), strict=True):
                        if hot:
                            k = np.arange(x, y)
                            wins.append((np.full(y - x, doc), to_long(span(prefix(BYTE_CODE[np.frombuffer(part, np.uint8)]), k, k + length)), a + k))
                        else:
                            runs.append((doc, key, a + x, y - x, part[x : y + length - 1]))
            if runs:
                doc, key, at, n, part = zip(*runs, strict=True)
                yield packed(np.full(len(runs), FRESH), doc, key, at, n, part)
            if wins:
                doc, key, at = (np.concatenate(x) for x in zip(*wins, strict=True))
                some = once_a_document(at, key, doc)
                doc, key, at = doc[some], key[some], at[some]
                late = doc > first_of(key, key, doc)
                d, a, n = stretches(doc[late], at[late])
                yield packed(np.full(len(d), REPEATED), d, np.zeros(len(d)), a, n, [None] * len(d))
                doc, key, at = doc[~late], key[~late], at[~late]
                yield packed(np.full(len(doc), FRESH), doc, key, at, np.ones(len(doc)), [None] * len(doc))

    def packed(*columns) -> pa.RecordBatch:
        kinds = (pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(v).astype(t.to_pandas_dtype()) if t != pa.binary() else v, t) for v, t in zip(columns, kinds, strict=True)], ["kind", "doc_id", "key", "at", "n", "bytes"])

    return mapped(told, emit, "kind byte, doc_id long, key long, at int, n int, bytes binary")


def sorted_shard(doc: np.ndarray, at: np.ndarray, pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(doc, at, n) of the stretches of windows in `pieces` that a smaller document also has."""
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)  # 0xFF isn't in UTF-8
    size = np.array([len(b) for b in pieces])
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    sa, cls = repeat_classes(text, length)
    piece = np.repeat(np.arange(len(size)), size + 1)[sa]
    off = sa - start[piece]
    ok = off + length <= size[piece]
    cls, piece, off = cls[ok], piece[ok], off[ok]
    own = doc[piece]
    edge = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
    first = np.repeat(np.minimum.reduceat(own, edge), np.diff(np.append(edge, len(cls))))
    late = own > first
    d, a = own[late], at[piece[late]] + off[late]
    return stretches(d, a)


def sort_shards(length: int, shard_bytes: int) -> Callable:
    """Rows in order of their keys; those of adjacent keys in shards of about shard_bytes,
    those of one key always together."""

    def answer(d: np.ndarray, a: np.ndarray, k: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(np.asarray(a).astype(np.int32)), pa.array(np.asarray(k).astype(np.int32))], ["doc_id", "at", "n"])

    def decided(t: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, key, at, n = (t.column(x).to_numpy() for x in ("doc_id", "key", "at", "n"))
        parts = t.column("bytes").combine_chunks()
        single = parts.is_null().to_numpy(zero_copy_only=False)
        if single.any():
            late = doc[single] > first_of(key[single], key[single], doc[single])
            yield answer(doc[single][late], at[single][late], n[single][late])
        if not single.all():
            yield answer(*sorted_shard(doc[~single], at[~single], parts.drop_null().to_pylist(), length))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            kind, doc, at, n = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("kind", "doc_id", "at", "n"))
            done = kind == REPEATED
            yield answer(doc[done], at[done], n[done])
            batch = batch.filter(pa.array(~done))
            while batch.num_rows:
                key = batch.column(batch.schema.get_field_index("key")).to_numpy()
                total = size + np.cumsum(batch.column(batch.schema.get_field_index("n")).to_numpy().astype(np.int64) + length)
                before = held[-1].column(batch.schema.get_field_index("key"))[-1].as_py() if held else key[0]
                ends = np.flatnonzero(np.append(before, key[:-1]) != key)  # a new key begins here
                ends = ends[np.append(size, total)[ends] >= shard_bytes]
                stop = int(ends[0]) if len(ends) else batch.num_rows
                if stop:
                    held.append(batch.slice(0, stop))
                    size = int(total[stop - 1])
                if not len(ends):
                    break
                yield from decided(pa.Table.from_batches(held))
                held, size = [], 0
                batch = batch.slice(stop)
        if held:
            yield from decided(pa.Table.from_batches(held))

    return emit


def own_repeats(c: Chunk, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(doc, at, n) of the stretches of windows that start earlier in their own document, too.
    Only what lies around recurring places is sorted, all documents of the chunk together."""
    z = np.zeros(0, np.int64)
    if not (np.diff(c.offsets) >= length).any():
        return z, z, z
    place, doc = recurring(c, length, anchor, *window_keys(c, length, anchor))
    if not len(place):
        return z, z, z
    a = np.maximum(place - (length - anchor), c.offsets[doc])
    b = np.minimum(place + length, c.offsets[doc + 1])
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (a[1:] > b[:-1])))  # overlapping ones are one
    a, b, doc = a[new], b[np.append(new[1:], len(b)) - 1], doc[new]
    text = np.frombuffer(b"\xff".join(c.data[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)) + b"\xff", np.uint8)
    start = np.concatenate([[0], np.cumsum(b - a + 1)[:-1]])
    sa, cls = repeat_classes(text, length)
    piece = np.searchsorted(start, sa, "right") - 1
    off = sa - start[piece]
    ok = off + length <= (b - a)[piece]
    cls, at, own = cls[ok], (a[piece] + off)[ok], doc[piece[ok]]
    late = at > first_of(cls, own, at)
    own, at, n = stretches(own[late], at[late])
    return own, at - c.offsets[own], n


def cut(told: DataFrame, length: int, anchor: int) -> DataFrame:
    """Remove each document's listed stretches and the repeats within it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch.column(batch.schema.get_field_index("drops"))
            within = batch.column(batch.schema.get_field_index("within")).fill_null(False).to_numpy(zero_copy_only=False)
            for c in chunks(batch):
                listed = drops.slice(c.first_row, len(c))
                gone = listed.flatten()
                doc = np.repeat(np.arange(len(c)), listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                at, n = (gone.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                some = np.flatnonzero(within[c.first_row : c.first_row + len(c)])
                if len(some):
                    ends = np.concatenate([[0], np.cumsum(np.diff(c.offsets)[some])])
                    part = np.concatenate([c.data[c.offsets[i] : c.offsets[i + 1]] for i in some])
                    own, a, m = own_repeats(Chunk(c.ids[some], part, ends, 0), length, anchor)
                    doc, at, n = np.append(doc, some[own]), np.append(at, a), np.append(n, m)
                size = len(c.data)
                at += c.offsets[doc]
                step = np.bincount(at, minlength=size + 1) - np.bincount(at + n + length - 1, minlength=size + 1)
                bad = np.cumsum(step[:-1]) > 0
                begins = bad.copy()
                begins[1:] &= ~bad[:-1]
                heads = c.offsets[:-1][np.diff(c.offsets) > 0]
                begins[heads] = bad[heads]
                told_ = lambda x: np.append(0, np.cumsum(x))[c.offsets]  # noqa: E731, B023
                lost, spans = told_(bad), np.diff(told_(begins))
                kept = pa.Array.from_buffers(pa.binary(), len(c), [None, pa.py_buffer((c.offsets - lost).astype(np.int32)), pa.py_buffer(c.data[~bad])])
                yield pa.RecordBatch.from_arrays([pa.array(c.ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (np.diff(c.offsets), np.diff(lost), spans)), kept], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return mapped(told, emit, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def dedup_strings(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of each row of `docs`."""
    docs = id_and_text(docs)
    apart = numbered_texts(docs)
    if apart is None:
        return dedup_texts(docs, length, anchor, shard_bytes)
    texts, rows = apart
    found = dedup_texts(texts, length, anchor, shard_bytes).withColumnRenamed("doc_id", "row_id")
    return rows.join(found, "row_id").drop("row_id")


def dedup_texts(docs: DataFrame, length: int, anchor: int, shard_bytes: int) -> DataFrame:
    """The same for rows of which equal doc_ids have equal texts."""
    parts = partitions_of(docs)
    frequent = frequent_keys(docs, length, anchor)
    rows = run_rows(docs, length, anchor, frequent).repartition(parts, F.expr(DEALT)).sortWithinPartitions("key", "run", "doc_id")
    judged = materialised(mapped(rows, judge, "kind byte, doc_id long, key long, at int, n int, often boolean"))
    opened = judged.where(F.col("kind") == OPEN).groupBy("doc_id").agg(F.collect_list(F.struct("key", "at", "n", "often")).alias("open"))
    pieces = open_bytes(docs.join(opened.hint("shuffle_hash"), "doc_id"), length, anchor, frequent_parts(docs, length, anchor, frequent))
    # equal windows have equal keys, so all that can be equal is in one partition
    pieces = pieces.repartition(parts, F.expr(f"CASE WHEN kind = {REPEATED} THEN doc_id ELSE key END")).sortWithinPartitions("key")
    sorted_ = mapped(pieces, sort_shards(length, shard_bytes), "doc_id long, at int, n int")
    found = judged.where(F.col("kind") == REPEATED).select("doc_id", "at", "n").union(sorted_)
    drops = found.select("doc_id", F.struct("at", "n").alias("s"), F.lit(False).alias("w"))
    own = judged.where(F.col("kind") == WITHIN).select("doc_id", F.lit(None).cast("struct<at:int,n:int>").alias("s"), F.lit(True).alias("w"))
    drops = drops.union(own).groupBy("doc_id").agg(F.collect_list("s").alias("drops"), F.max("w").alias("within"))
    told = docs.join(drops.hint("shuffle_hash"), "doc_id", "left")
    return cut(told, length, anchor)
