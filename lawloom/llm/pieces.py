"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut into words (a run of blanks with the word after it, a run of blanks, a
newline), and words into units between characters that stand side by side in no piece: no
piece can cross there, so units are encoded on their own.  Documents are read in blocks; each
block numbers its distinct units, and the distinct units of the corpus are encoded once:

1. explode each unit's substrings up to the longest piece's length,
2. equi-join them with the piece table (a broadcast: its size is the vocabulary's),
3. group the edges by unit,
4. fold each unit's edges with Spark's higher-order `aggregate`,
5. send the units' ids back to the blocks, where documents are put together and decoded.

For a unigram vocabulary the fold is Viterbi's (the path of the highest sum of scores).  In
a byte-pair vocabulary scores are merge ranks, and the highest sum isn't what the library
gives; there the fold applies the merges the edges allow, best rank first and leftmost among
equals, which is the library's result.  Units longer than 60 characters are encoded by the
same rule in plain Python.

A block numbers its units by the order of their 64-bit hashes.  A text whose ids don't decode
to itself, as after a collision of hashes, is encoded anew in plain Python; a block of which
the lattice has not answered every unit is an error.  A block's rows must be the same each
time they are read, as those of files are.

Defined results: a null or empty text has no ids; characters without a piece become byte
pieces; U+2581 in a text means a blank, as in the library, so such a text decodes to blanks
there (`round_trip` compares with that); of edges of equal rank the leftmost is merged first;
a very long text is a block of its own; rows of equal doc_id are each encoded; rows without a
doc_id are left out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U, Chunk, chunks, driver_rows, id_and_text, mapped, mix, partitions_of, prefix, released, span

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 1 << 18  # of a block that are cut into units at a time: some thirty bytes of memory each
NONE = (1 << 18) - 1  # stands for no piece in a packed edge
MAX_UNIT = 60  # characters of a unit that Spark encodes; boundaries are bits of a long


@dataclass
class Vocabulary:
    """Pieces that match text, by rank (0 is merged first), and the ids of the 256 bytes."""

    ids: dict[str, int]
    rank: dict[str, int]
    score: dict[str, float]
    byte_ids: list[int]
    merges: bool = True
    texts: list[bytes] = field(default_factory=list)  # what each id stands for
    longest: int = 16

    def __post_init__(self) -> None:
        """The characters of longer pieces, and which of them stand side by side in one."""
        wide = [p for p in self.ids if len(p) > 1]
        self.alphabet = np.array(sorted({ord(c) for p in wide for c in p}), np.uint32)
        at = {int(c): i for i, c in enumerate(self.alphabet)}
        self.side = np.zeros((len(at) + 1, len(at) + 1), bool)  # the last stands for any other
        for p in wide:
            for a, b in zip(p, p[1:], strict=False):
                self.side[at[ord(a)], at[ord(b)]] = True
        # place of each character in the alphabet, for all that come before its last one
        self.place = np.full(int(self.alphabet[-1]) + 2 if len(at) else 1, len(at), np.uint16)
        self.place[self.alphabet] = np.arange(len(at))
        self.length = np.fromiter(map(len, self.texts), np.int64, len(self.texts))


def load(model: str = MODEL, merges: bool = True) -> Vocabulary:
    """Read a model file with the library; merges: byte-pair rather than unigram scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    other = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    plain = {sp.id_to_piece(i): i for i in range(n) if not other(i)}
    score = {p: sp.get_score(i) for p, i in plain.items()}
    levels = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    texts = [b""] * n
    for p, i in plain.items():
        texts[i] = p.replace(BLANK, " ").encode()
    for b, i in enumerate(byte_ids):
        texts[i] = bytes([b])
    return Vocabulary(plain, {p: levels[s] for p, s in score.items()}, score, byte_ids, merges, texts, max(map(len, plain), default=1))


# ------------------------------------------------------------ the same in plain Python


def encode_unit(unit: str, v: Vocabulary) -> list[int]:
    """One unit by the rule of the fold; a helper for units that Spark leaves out, and for a
    whole text (with a blank in front) after a collision."""
    parts = list(unit)
    if v.merges:
        import heapq

        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        heap: list[tuple] = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and (r := v.rank.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i] if parts[i] else -1
            if j < 0 or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        parts = [p for p in parts if p]
    else:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for e in range(1, len(unit) + 1):
            options = [(best[s][0] + v.score[unit[s:e]], s) for s in range(max(0, e - v.longest), e) if unit[s:e] in v.score]
            best.append(max(options, default=(best[e - 1][0] - 1e6, e - 1), key=lambda o: (o[0], -o[1])))
        cuts = [len(unit)]
        while cuts[-1]:
            cuts.append(best[cuts[-1]][1])
        cuts.reverse()
        parts = [unit[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    out: list[int] = []
    for p in parts:
        out += [v.ids[p]] if p in v.ids else [v.byte_ids[b] for b in p.encode()]
    return out


def decode(ids: np.ndarray, v: Vocabulary) -> bytes:
    return b"".join(map(v.texts.__getitem__, ids.tolist())).removeprefix(b" ")


# ------------------------------------------------------------ blocks of documents


@dataclass
class Units:
    """The units of a chunk: its characters (blanks as U+2581, one in front of each text), the
    boundaries of the units among them, each unit's hash, and each document's first unit."""

    code: np.ndarray
    cut: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, i: int) -> str:
        return self.code[self.cut[i] : self.cut[i + 1]].tobytes().decode("utf-32-le")

    def texts(self, some: np.ndarray) -> list[str]:
        """The units `some`, decoded in one go."""
        size = self.cut[some + 1] - self.cut[some]
        ends = np.cumsum(size)
        at = np.repeat(self.cut[some] - (ends - size), size) + np.arange(int(size.sum()))
        whole, ends = self.code[at].tobytes().decode("utf-32-le"), ends.tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def units_of(c: Chunk, v: Vocabulary) -> Units:
    code = np.frombuffer(c.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begun = np.concatenate([[0], np.cumsum((c.data & 0xC0) != 0x80)])[c.offsets]  # in characters
    full = np.diff(begun) > 0
    code = np.insert(code, begun[:-1][full], ord(BLANK))
    code[code == 0x20] = ord(BLANK)
    begun += np.concatenate([[0], np.cumsum(full)])
    at = np.take(v.place, np.minimum(code, len(v.place) - 1)).astype(np.intp)
    blank, line = code == ord(BLANK), code == 0x0A
    edge = np.ones(len(code) + 1, bool)
    if len(code):
        apart = ~np.take(v.side, at[:-1] * len(v.side) + at[1:])
        edge[1:-1] = apart | line[1:] | line[:-1] | (blank[1:] & ~blank[:-1])
    edge[begun] = True
    cut = np.flatnonzero(edge)
    hashes = span(prefix(mix(code.astype(U) + U(1))), cut[:-1], cut[1:])
    return Units(code, cut, hashes, np.searchsorted(cut, begun))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[Chunk]]]:
    """(block, chunks): consecutive rows of a partition of about BLOCK_BYTES.  A block is named by
    a digest of its ids and texts, so the same rows give the same block, whoever reads them, and
    blocks of one name are equal."""
    held: list[Chunk] = []
    size = 0

    def name() -> int:
        digest = xxhash.xxh3_128()
        for c in held:
            for part in (c.ids, c.offsets, c.data):
                digest.update(np.ascontiguousarray(part))
        return digest.intdigest() >> 65

    for batch in batches:
        for c in chunks(batch, size=SLICE_BYTES):
            held.append(c)
            size += len(c.data)
            if size >= BLOCK_BYTES:
                yield name(), held
                held, size = [], 0
    if held:
        yield name(), held


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two ascending arrays as one (a stable sort merges runs)."""
    return np.sort(np.concatenate([a, b]), kind="stable")


def name_units(v: Vocabulary) -> Callable:
    """(block, number, unit) of each distinct unit of each block that Spark encodes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in blocks(batches):
            known, hashes, texts = np.zeros(0, U), [], []
            for c in held:
                u = units_of(c, v)
                new, at = np.unique(u.hashes, return_index=True)
                fresh = ~np.isin(new, known, assume_unique=True)
                known = merged(known, new[fresh])
                wide = u.cut[at + 1] - u.cut[at] <= MAX_UNIT
                hashes.append(new[fresh & wide])
                texts.append(pa.array(u.texts(at[fresh & wide]), pa.string()))
            for h, t in zip(hashes, texts, strict=True):
                number = np.searchsorted(known, h).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), block)), pa.array(number), t], ["block", "number", "unit"])

    return emit


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block as one compressed row, so that whole texts are shuffled once and small."""
    press = zstandard.ZstdCompressor(level=3)
    for block, held in blocks(batches):
        parts = []
        for c in held:
            rows = [pa.array(c.ids, pa.int64()), pa.Array.from_buffers(pa.large_binary(), len(c), [None, pa.py_buffer(c.offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(c.data))])]
            sink = pa.BufferOutputStream()
            batch = pa.RecordBatch.from_arrays(rows, ["doc_id", "text"])
            with pa.ipc.new_stream(sink, batch.schema) as w:
                w.write_batch(batch)
            parts.append(press.compress(sink.getvalue()))
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([parts], pa.list_(pa.binary()))], ["block", "packed"])


def unpack(parts: pa.Scalar) -> Iterator[Chunk]:
    press = zstandard.ZstdDecompressor()
    for part in parts.values:
        batch = pa.ipc.open_stream(press.decompress(part.as_py())).read_next_batch()
        text = batch.column(1)
        off, data = (np.frombuffer(b, t) if b is not None and b.size else np.zeros(0, t) for b, t in zip(text.buffers()[1:], (np.int64, np.uint8), strict=True))
        yield Chunk(batch.column(0).to_numpy(), data, off[: len(text) + 1], 0)


PIECES_AT_ONCE = 1 << 16  # ids that are decoded at a time, to compare them with the text
ANSWERS = 500_000  # rows of a partition that are packed at a time


def pack_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's rows of block, number and ids as compressed rows, one for each block in
    each ANSWERS rows; in order of the numbers, which compress best so."""
    press = zstandard.ZstdCompressor(level=3)
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        block, number = t["block"].to_numpy(), t["number"].to_numpy()
        by = np.lexsort((number, block))
        block, number = block[by], number[by]
        ids = t["ids"].combine_chunks()
        size = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat, size = gathered(ids.flatten().to_numpy(zero_copy_only=False), size, by), size[by]
        edge = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist()
        ends = np.concatenate([[0], np.cumsum(size)])
        out = []
        for a, b in zip(edge, [*edge[1:], len(block)], strict=True):
            some = flat[ends[a] : ends[b]].astype(np.uint32)
            steps = np.diff(number[a:b], prepend=0).astype(np.uint32)
            planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in (steps, some)]
            out.append(press.compress(np.array([b - a, len(some)], np.int64).tobytes() + size[a:b].astype(np.uint8).tobytes() + planes[0] + planes[1]))
        return pa.RecordBatch.from_arrays([pa.array(block[edge], pa.int64()), pa.array(out, pa.binary())], ["block", "answers"])

    n = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= ANSWERS:
            yield packed()
            held, n = [], 0
    if held:
        yield packed()


def gathered(flat: np.ndarray, size: np.ndarray, some: np.ndarray) -> np.ndarray:
    """The lists `some` one after the other, of lists of `size` that lie in `flat`."""
    start = (np.cumsum(size) - size)[some]
    take = size[some]
    ends = np.cumsum(take)
    return flat[np.repeat(start - (ends - take), take) + np.arange(int(take.sum()))]


def unpack_answers(blobs: pa.ChunkedArray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units in order, their number for each unit; 0 without an answer)."""
    press = zstandard.ZstdDecompressor()
    numbers, sizes, flats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for blob in blobs:
        data = press.decompress(blob.as_py())
        n, m = np.frombuffer(data, np.int64, 2).tolist()
        plane = lambda k, at: np.ascontiguousarray(np.frombuffer(data, np.uint8, 4 * k, at).reshape(4, k).T).view(np.uint32).ravel()  # noqa: E731, B023
        sizes.append(np.frombuffer(data, np.uint8, n, 16).astype(np.int64))
        numbers.append(np.cumsum(plane(n, 16 + n).astype(np.int64)))
        flats.append(plane(m, 16 + 5 * n).astype(np.int32))
    number, size, flat = np.concatenate(numbers), np.concatenate(sizes), np.concatenate(flats)
    if len(number) and number.max() >= units:
        raise RuntimeError("the rows of a block changed between two reads: write the input first")
    number, first = np.unique(number, return_index=True)  # equal blocks have asked for the same
    every = np.zeros(units, np.int64)
    every[number] = size[first]
    return gathered(flat, size, first), every


# ------------------------------------------------------------ the lattice


def _part(x: Column, low: int, bits: int) -> Column:
    return F.shiftright(x, low).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k)


# fields of an edge, packed as one number: rank, first character, end, id
def rank_of(x: Column) -> Column:
    return _part(x, 30, 18)


def start_of(x: Column) -> Column:
    return _part(x, 24, 6)


def end_of(x: Column) -> Column:
    return _part(x, 18, 6)


def id_of(x: Column) -> Column:
    return _part(x, 0, 18)


def lattice(units: DataFrame, v: Vocabulary) -> DataFrame:
    """(unit, edges): for each unit the substrings that are pieces, and its single characters.

    An edge is one number (`rank_of`, `start_of`, `end_of`, `id_of`), which keeps the grouping
    small; edges are in order of rank, then of their start.
    """
    if len(v.texts) >= NONE or len(v.rank) >= NONE:
        raise ValueError(f"a vocabulary of {NONE} pieces or more needs wider edges")
    spark = units.sparkSession
    table = driver_rows(spark, [(p, v.rank[p] << 30 | i) for p, i in v.ids.items()], pa.schema([("piece", pa.string()), ("code", pa.int64())]))
    # two plain generators rather than nested lambdas, which Spark would interpret
    at = units.select("unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("s"))
    at = at.select("unit", "s", F.explode(F.sequence(F.col("s") + 1, F.least(F.col("s") + v.longest, F.length("unit")))).alias("e"))
    rows = at.select("unit", "s", "e", F.expr("substring(unit, s + 1, e - s)").alias("piece"))
    hits = rows.join(F.broadcast(table), "piece", "left").where("code IS NOT NULL OR e = s + 1")
    edge = F.shiftleft(F.col("s").cast("long"), 24).bitwiseOR(F.shiftleft(F.col("e").cast("long"), 18)).bitwiseOR(F.coalesce("code", F.lit(NONE << 30 | NONE)))
    return hits.groupBy("unit").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def wide_edges(edges: Column) -> Column:
    """Edges of two characters or more: rank, start, the bits of both ends and those inside."""
    some = F.filter(edges, lambda x: end_of(x) > start_of(x) + 1)
    return F.transform(
        some,
        lambda x: F.struct(
            rank_of(x).alias("rank"),
            start_of(x).alias("s"),
            _bit(start_of(x)).bitwiseOR(_bit(end_of(x))).alias("ends"),
            (_bit(end_of(x)) - 1).bitwiseAND(F.bitwise_not(_bit(start_of(x) + 1) - 1)).alias("inner"),
        ),
    )


def joins(mask: Column, x: Column) -> Column:
    """Whether an edge joins two adjacent parts: its ends are boundaries, and one is inside."""
    return (mask.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(mask.bitwiseAND(x["inner"])) == 1)


def merge_in_order(wide: Column) -> Column:
    """Boundaries (bits 0 to 61) after one pass over the edges in order of rank and start, each
    of which loses the boundary inside it if it joins two parts.  That is the result of all
    merges unless a merge lets an edge of a better rank join; bit 62 says that one did."""

    def step(mask: Column, x: Column) -> Column:
        after = mask.bitwiseAND(F.bitwise_not(x["inner"]))
        late = F.exists(wide, lambda y: (y["rank"] < x["rank"]) & joins(after, y))
        return F.when(joins(mask, x), F.when(late, after.bitwiseOR(F.lit(1 << 62))).otherwise(after)).otherwise(mask)

    return F.aggregate(wide, F.lit((1 << 62) - 1), step)


def merge_fold(wide: Column, n: Column) -> Column:
    """Boundaries after all merges: in each step the edge of the best rank, leftmost among
    equals, that joins two adjacent parts loses the boundary inside it."""

    def step(mask: Column, _: Column) -> Column:
        best = F.array_min(F.transform(F.filter(wide, lambda x: joins(mask, x)), lambda x: F.struct(x["rank"].alias("rank"), x["s"].alias("s"), x["inner"].alias("inner"))))
        return F.when(best.isNull(), mask).otherwise(mask.bitwiseAND(F.bitwise_not(best["inner"])))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.lit((1 << 62) - 1), step)


def viterbi_fold(edges: Column, n: Column, v: Vocabulary) -> Column:
    """Boundaries (bits) of the path of the highest sum of scores: an array of the best (score,
    boundaries) for each position, extended position by position; leftmost edges win ties."""
    first = F.array(F.struct(F.lit(0.0).cast("double").alias("score"), F.lit(1).cast("long").alias("cuts")))
    by_rank = {v.rank[p]: x for p, x in v.score.items()}
    scores = F.lit([by_rank[r] for r in sorted(by_rank)])  # ranks count from 0 without gaps

    def step(best: Column, e: Column) -> Column:
        into = F.transform(
            F.filter(edges, lambda x: end_of(x) == e),
            lambda x: F.struct((F.get(best, start_of(x))["score"] + F.coalesce(F.get(scores, rank_of(x)), F.lit(-1e6))).alias("score"), (-start_of(x)).alias("s"), F.get(best, start_of(x))["cuts"].bitwiseOR(_bit(e)).alias("cuts")),
        )
        top = F.array_max(into)
        return F.concat(best, F.array(F.struct(top["score"].alias("score"), top["cuts"].alias("cuts"))))

    return F.aggregate(F.sequence(F.lit(1), n), first, step, lambda b: F.get(b, n)["cuts"])


def encoded_units(units: DataFrame, v: Vocabulary) -> DataFrame:
    """(unit, ids) for distinct units of at most MAX_UNIT characters."""
    d = lattice(units, v)
    if v.merges:
        d = d.select("unit", "edges", wide_edges(F.col("edges")).alias("wide"))
        d = d.select("unit", "edges", "wide", merge_in_order(F.col("wide")).alias("cuts"))
        d = d.select("unit", "edges", F.when(F.col("cuts") < F.lit(1 << 62), F.col("cuts")).otherwise(merge_fold(F.col("wide"), F.length("unit"))).alias("cuts"))
    else:
        d = d.select("unit", "edges", viterbi_fold(F.col("edges"), F.length("unit"), v).alias("cuts"))
    # an edge is on the path if the next boundary after its start is its end
    on = lambda x: F.call_function("shiftright", F.col("cuts"), start_of(x)).bitwiseAND(_bit(end_of(x) - start_of(x) + 1) - 1) == _bit(end_of(x) - start_of(x)).bitwiseOR(F.lit(1).cast("long"))
    path = F.sort_array(F.transform(F.filter("edges", on), lambda x: F.struct(start_of(x).alias("s"), id_of(x).alias("i"))))

    def ids(x: Column) -> Column:
        code = F.hex(F.encode(F.substring("unit", x["s"] + 1, F.lit(1)), "utf-8"))
        raw = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda k: F.get(F.lit(v.byte_ids), F.conv(F.substring(code, k, F.lit(2)), 16, 10).cast("int")))
        return F.when(x["i"] != NONE, F.array(x["i"])).otherwise(raw)

    return d.select("unit", F.flatten(F.transform(path, ids)).alias("ids"))


# ------------------------------------------------------------ documents


def put_together(packed: pa.Scalar, answers: pa.ChunkedArray, v: Vocabulary, strict: bool = False) -> pa.Table:
    """The rows of a block from its texts and the ids of its units; strict: see `encode`."""
    known = np.zeros(0, U)
    wide: dict[int, list[int]] = {}  # units that Spark leaves out, by hash
    inside: list[tuple[np.ndarray, ...]] = []  # for each chunk its units, which of them stands where, each document's first
    for c in unpack(packed):
        u = units_of(c, v)
        new, which = np.unique(u.hashes, return_inverse=True)
        inside.append((new, which.astype(np.int32), u.first))
        known = merged(known, new[~np.isin(new, known, assume_unique=True)])
        for i in np.flatnonzero(np.diff(u.cut) > MAX_UNIT).tolist():
            if (h := int(u.hashes[i])) not in wide:
                wide[h] = encode_unit(u.text(i), v)
        del u, which
    released()  # what the chunks have freed; before the rows grow, too
    flat, size = unpack_answers(answers, len(known))
    start = np.cumsum(size) - size
    released()
    if wide:
        at = np.searchsorted(known, np.array(list(wide), U))
        lengths = np.fromiter(map(len, wide.values()), np.int64, len(wide))
        start[at] = len(flat) + np.cumsum(lengths) - lengths
        size[at] = lengths
        flat = np.concatenate([flat, *(np.array(x, np.int32) for x in wide.values())])
    if not size.all():
        raise RuntimeError("a block has units without an answer: its rows changed between two reads, write the input first")
    out: list[pa.RecordBatch] = []
    inside.reverse()
    for c in unpack(packed):
        new, which, first = inside.pop()
        unit = np.searchsorted(known, new).astype(np.int32)[which]
        del new, which
        take = size[unit]
        ends = np.concatenate([[0], np.cumsum(take)])
        ids = flat[np.repeat(start[unit] - ends[:-1], take) + np.arange(int(ends[-1]))]
        edges = ends[first]
        same = decoded_as(ids, edges, c, v)
        if not same.all():  # never seen: two units of a block with one hash
            if strict:
                raise RuntimeError(f"{int((~same).sum())} texts don't decode to themselves")
            lists = [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            for i in np.flatnonzero(~same).tolist():
                lists[i] = np.array(encode_unit(BLANK + c.text(i).decode().replace(" ", BLANK), v), np.int32)
                same[i] = decode(lists[i], v) == c.text(i).decode().replace(BLANK, " ").encode()
            ids, edges = np.concatenate(lists), np.concatenate([[0], np.cumsum(list(map(len, lists)))])
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))
        out.append(pa.RecordBatch.from_arrays([pa.array(c.ids, pa.int64()), pa.array(np.diff(edges), pa.int64()), lists, pa.array(same)], ["doc_id", "n_tokens", "ids", "round_trip"]))
    return pa.Table.from_batches(out)


def decoded_as(ids: np.ndarray, edges: np.ndarray, c: Chunk, v: Vocabulary) -> np.ndarray:
    """Whether each document's ids stand for its own text (U+2581 for a blank)."""
    full = np.diff(c.offsets) > 0
    text = np.insert(c.data, c.offsets[:-1][full], 0x20).tobytes()  # each text's leading blank
    want = c.offsets + np.concatenate([[0], np.cumsum(full)])
    if BLANK.encode() in text:
        texts = [text[a:b].replace(BLANK.encode(), b" ") for a, b in zip(want[:-1], want[1:], strict=True)]
        text, want = b"".join(texts), np.concatenate([[0], np.cumsum(list(map(len, texts)))])
    have = np.concatenate([[0], np.cumsum(v.length[ids])])[edges]
    if np.array_equal(want, have):
        at, equal = 0, True
        for some in np.split(ids, range(PIECES_AT_ONCE, len(ids), PIECES_AT_ONCE)):
            part = b"".join(map(v.texts.__getitem__, some.tolist()))
            equal = equal and text.startswith(part, at)
            at += len(part)
        if equal:
            return np.ones(len(c), bool)
    data = b"".join(map(v.texts.__getitem__, ids.tolist()))
    return np.array([data[a:b] == text[d:e] for a, b, d, e in zip(have[:-1], have[1:], want[:-1], want[1:], strict=True)], bool)


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, strict: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip (whether the ids decode to the text) of each row.

    strict: a text that would be encoded anew in plain Python is an error instead.
    """
    v = vocabulary or load()
    docs = id_and_text(docs)
    parts = partitions_of(docs)
    named = mapped(docs, name_units(v), "block long, number int, unit string").repartition(4 * parts, "unit")
    # with the block, so that both uses read the same columns and share one shuffle
    words = named.groupBy("unit").agg(F.min("block").alias("block"), F.min("number").alias("number")).where("block IS NOT NULL AND number IS NOT NULL").select("unit")
    answers = mapped(named.join(encoded_units(words, v).hint("shuffle_hash"), "unit").select("block", "number", "ids"), pack_answers, "block long, answers binary")
    packed = mapped(docs, pack, "block long, packed array<binary>")

    def put(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = [put_together(x, right["answers"], v, strict) for x in left["packed"]]
        released()
        return pa.concat_tables(tables) if tables else pa.table({"doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32())), "round_trip": pa.array([], pa.bool_())})

    both = packed.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(put, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_table(encoded: DataFrame, spark: SparkSession, vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id and text of encoded rows."""
    v = vocabulary or load()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode(np.asarray(x or [], np.int64), v).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return mapped(encoded.select("doc_id", "ids"), emit, "doc_id long, text string")
