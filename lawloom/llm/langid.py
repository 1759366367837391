"""Language identification by error-correcting output codes.

Each language gets a codeword of bits.  For each bit a binary classifier over hashed byte
trigrams (log odds between the languages with the bit and those without it) is learned;
its error on the training rows gives its weight in decoding.  A text's margins are decoded
to the codeword with the least weighted logistic loss; if the runner-up is about as near,
the text is flagged ambiguous.

Learning reads a sample of at most `max_train` labelled documents in expectation for each
language, chosen by a hash of the id; what is collected is one row for each language and
bucket.  Prediction is one map over all rows with the learned table in the closure
(buckets x bits numbers, whatever the corpus' size).

Defined results: a null text or one without a letter is `und` with score 0; without any
labelled rows everything is `und`; with a single language it is predicted for each text
with a letter, score 1; a very long text is one row of counts however long; equal losses go to the language that sorts first; extra columns are
ignored, repeated rows are all returned, rows without a doc_id are left out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Chunk, chunks, id_and_text, mapped, owner

BUCKETS = 1 << 12
MAX_TRAIN = 4000
AMBIGUOUS = 0.02
CHUNK_ROWS = 512  # documents counted at a time, each in a row of BUCKETS numbers

# letters to lower case, other ASCII to a blank; bytes of longer characters stay
_CODE = np.full(256, 0x20, np.int32)
_CODE[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CODE[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CODE[128:] = np.arange(128, 256)


def trigram_counts(c: Chunk) -> np.ndarray:
    """documents x BUCKETS counts of hashed byte trigrams within documents."""
    x = _CODE[c.data].astype(np.uint32)
    doc = owner(c.offsets)
    if len(x) < 3:
        return np.zeros((len(c), BUCKETS))
    h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    bucket = (h >> np.uint32(20)).astype(np.int64)
    inside = (doc[:-2] == doc[2:]) & ~((x[:-2] == 0x20) & (x[1:-1] == 0x20))
    return np.bincount((doc[:-2] * BUCKETS + bucket)[inside], minlength=len(c) * BUCKETS).reshape(len(c), BUCKETS)


def has_letter(text: bytes) -> bool:
    return any(ch.isalpha() for ch in text.decode())


def codewords(n: int, bits_for_many: int = 15) -> np.ndarray:
    """languages x bits of -1 and 1: every split for up to six languages, else the random
    code of the largest least distance among some drawn with a fixed seed."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:  # the first language has bit 1 throughout, so that no split comes twice
        rest = [r for r in itertools.product((-1, 1), repeat=n - 1) if -1 in r]
        return np.array([(1, *r) for r in rest], float).T
    rng, best, least = np.random.default_rng(7), None, -1
    bits = int(np.ceil(bits_for_many * np.log2(n)))
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        gram = code @ code.T
        np.fill_diagonal(gram, -np.inf)
        far = code.shape[1] - gram.max()
        if far > least:
            best, least = code, far
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits: log odds of the bit
    scale: np.ndarray  # bits: margin to logit
    trust: np.ndarray  # bits: weight of the bit's loss

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """documents x languages: mean weighted logistic loss of each codeword."""
        margin = (counts @ self.weights) / np.maximum(counts.sum(1, keepdims=True), 1)
        z = np.clip(margin * self.scale, -30, 30)
        wrong = np.logaddexp(0, -z) * self.trust, np.logaddexp(0, z) * self.trust
        pos, neg = (self.code > 0).astype(float), (self.code < 0).astype(float)
        return (wrong[0] @ pos.T + wrong[1] @ neg.T) / max(self.trust.sum(), 1e-9)


def training_rows(docs: DataFrame, max_train: int) -> tuple[DataFrame, list[str]]:
    """Labelled rows, each language thinned by a hash of the id to about max_train rows."""
    rows = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return rows, langs
    share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, max_train / counts[k])))]), F.col("lang"))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(17)), 11).cast("double") * F.lit(2.0**-53)
    return rows.where(u < share), langs


def fit(docs: DataFrame, max_train: int = MAX_TRAIN) -> Model | None:
    """Learn from text and lang of `docs`; None if no row has a lang."""
    rows, langs = training_rows(docs, max_train)
    code = codewords(len(langs))
    if not langs:
        return None
    if len(langs) == 1:
        return Model(langs, code, np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros(0))
    at = {k: i for i, k in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BUCKETS))
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            for c in chunks(batch, rows=CHUNK_ROWS):
                x = trigram_counts(c).astype(float)
                x /= np.maximum(x.sum(1, keepdims=True), 1)
                np.add.at(total, [at[names[c.first_row + i]] for i in range(len(c))], x)
        k, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(b, pa.int32()), pa.array(total[k, b])], ["k", "b", "w"])

    table = np.zeros((len(langs), BUCKETS))
    # rounded before the sum, so that the order of partial sums can't change the model
    for r in mapped(rows, count, "k int, b int, w double").groupBy("k", "b").agg(F.sum(F.round(F.col("w") * 1e6).cast("long")).alias("w")).collect():
        table[r["k"], r["b"]] = r["w"] / 1e6
    p = (table + 1e-4) / (table + 1e-4).sum(1, keepdims=True)
    weights = np.stack([np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0)) for b in range(code.shape[1])], 1)
    first = Model(langs, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrong, size, n = np.zeros(code.shape[1]), np.zeros(code.shape[1]), 0
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            for c in chunks(batch, rows=CHUNK_ROWS):
                x = trigram_counts(c)
                some = x.sum(1) > 0
                m = (x @ first.weights) / np.maximum(x.sum(1, keepdims=True), 1)
                y = code[[at[names[c.first_row + i]] for i in range(len(c))]]
                wrong += ((m * y) <= 0)[some].sum(0)
                size += np.abs(m[some]).sum(0)
                n += int(some.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(wrong)), pa.int32()), pa.array(wrong.astype(np.int64)), pa.array(np.round(size * 1e6).astype(np.int64)), pa.array(np.full(len(wrong), n, np.int64))], ["b", "wrong", "size", "n"])

    stats = mapped(rows, judge, "b int, wrong long, size long, n long").groupBy("b").agg(F.sum("wrong"), F.sum("size"), F.sum("n")).collect()
    scale, trust = np.ones(code.shape[1]), np.ones(code.shape[1])
    for b, wrong, size, n in stats:
        e = (wrong + 1) / (n + 2)
        trust[b] = max(0.05, 0.5 * np.log((1 - e) / e))
        scale[b] = 4.0 / max(size / 1e6 / max(n, 1), 1e-6)  # a mean margin is a logit of 4
    return Model(langs, code, weights, scale, trust)


def predict(docs: DataFrame, model: Model | None, ambiguous: float = AMBIGUOUS) -> DataFrame:
    """doc_id, lang_pred, score, runner_up, gap, ambiguous for each row."""
    schema = "doc_id long, lang_pred string, score double, runner_up string, gap double, ambiguous boolean"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, best, score, second, gap = [], [], [], [], []
            for c in chunks(batch, rows=CHUNK_ROWS):
                n, k = len(c), len(model.langs) if model else 0
                lost = model.losses(trigram_counts(c)) if k else np.zeros((n, 0))
                letters = np.array([has_letter(c.text(i)) for i in range(n)], bool)
                order = np.argsort(lost, 1, kind="stable")
                soft = np.exp(-8.0 * (lost - lost.min(1, keepdims=True))) if k else lost
                for i in range(n):
                    ok = k > 0 and letters[i]
                    ids.append(c.ids[i])
                    best.append(model.langs[order[i, 0]] if ok else "und")
                    score.append(float(soft[i, order[i, 0]] / soft[i].sum()) if ok else 0.0)
                    second.append(model.langs[order[i, 1]] if ok and k > 1 else None)
                    gap.append(float(lost[i, order[i, 1]] - lost[i, order[i, 0]]) if ok and k > 1 else None)
            near = [g is not None and g < ambiguous for g in gap]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in ((ids, pa.int64()), (best, pa.string()), (score, pa.float64()), (second, pa.string()), (gap, pa.float64()), (near, pa.bool_()))],
                ["doc_id", "lang_pred", "score", "runner_up", "gap", "ambiguous"],
            )

    return mapped(id_and_text(docs), emit, schema)


def identified(docs: DataFrame, model: Model | None, least_gap: float = AMBIGUOUS) -> DataFrame:
    """The rows of `docs`, all columns, that get a language: not those without a letter, nor
    those whose runner-up is nearer than least_gap."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch, rows=CHUNK_ROWS):
                lost = np.sort(model.losses(trigram_counts(c)), 1) if model else np.zeros((len(c), 0))
                clear = lost[:, 1] - lost[:, 0] >= least_gap if lost.shape[1] > 1 else np.full(len(c), lost.shape[1] == 1)
                keep = clear & [has_letter(c.text(i)) for i in range(len(c))]
                yield batch.slice(c.first_row, len(c)).filter(pa.array(keep, pa.bool_()))

    return mapped(docs.where("doc_id IS NOT NULL"), emit, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the documents that is never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def identify(docs: DataFrame, max_train: int = MAX_TRAIN, ambiguous: float = AMBIGUOUS) -> DataFrame:
    """Learn from the documents that aren't held out, predict all."""
    return predict(docs, fit(docs.where(~held_out()), max_train), ambiguous)
