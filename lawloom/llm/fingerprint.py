"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text is its words weighted by their counts.  For each word k and each draw, r and c are
Gamma(2, 1) and beta is uniform, all fixed by a hash of the word and the draw; then
t = floor(ln(weight) / r + beta) and ln a = ln c - r * (t - beta + 1), and the word of the
least a together with its t is a sample.  Two texts agree in a sample with a probability
equal to their generalised Jaccard likeness.  The gammas come from tables of quantiles, so
a draw costs one hash and two look-ups.

A fingerprint has DRAWS samples, each an independent draw over all words of the text, so
the rate of equal samples estimates that likeness whatever the weights are.

One shuffle deals the documents to buckets of adjacent ids, where the window for the next
document, the word counts and the samples are all computed without another exchange; the
highest document of each bucket is copied to the bucket above, which needs it as its next.

Defined results: a null or empty text, or one without words, has the empty fingerprint
(zeros); two empty fingerprints are alike (1), an empty and another one are not (0); with a
single document the next one is itself; rows of equal doc_id follow each other by text, and
repeated rows are each returned; of words with an equal least a the one of the least hash is
taken; a very long text is counted word by word like any other; words are told apart by 64-bit
hashes; rows without a doc_id are left out; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, id_and_text, partitions_of

DRAWS = 64
AT_ONCE = 4  # draws computed in one row; the generated code of more is too long to be compiled
BUCKET_DOCS = 256  # documents of a bucket, on average
CROWDED = 4  # times that many documents make a bucket worth cutting again
LEVELS = 5
MAX_BROADCAST = 100_000  # rows of the list of bucket heads that is broadcast; more are joined
CELLS = 1024  # cells of the quantile tables


def gamma2_quantiles(q: np.ndarray) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x)."""
    low, high = np.zeros_like(q), np.full_like(q, 60.0)
    for _ in range(80):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < q
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return (low + high) / 2


def _array(x: np.ndarray) -> Column:
    return F.split(F.lit(",".join(f"{v:.9g}" for v in x)), ",").cast("array<double>")


def _bits(h: Column, low: int, n: int) -> Column:
    return F.shiftrightunsigned(h, low).bitwiseAND(F.lit((1 << n) - 1))


def samples(counts: DataFrame, keys: list[str], draws: int = DRAWS) -> DataFrame:
    """keys and `samples`, an array of `draws` numbers (none is 0), from rows of keys, term
    (a 64-bit hash) and weight."""
    mid = (np.arange(CELLS) + 0.5) / CELLS
    r_table = _array(gamma2_quantiles(mid))
    # the lowest cell of c, where the least a comes from, is divided once more
    c_table = _array(np.log(np.concatenate([gamma2_quantiles(mid), gamma2_quantiles(mid / CELLS)])))
    firsts = range(0, draws, AT_ONCE)
    d = counts.select(*keys, "term", F.ln(F.col("weight").cast("double")).alias("lw"), F.explode(F.array(*[F.lit(g) for g in firsts])).alias("first"))
    d = d.select("*", *[F.xxhash64("term", F.col("first") + F.lit(j)).alias(f"h{j}") for j in range(AT_ONCE)])
    drawn = []
    for j in range(AT_ONCE):
        h = F.col(f"h{j}")
        r = F.get(r_table, F.shiftrightunsigned(h, 54).cast("int"))
        beta = (_bits(h, 30, 24).cast("double") + F.lit(0.5)) * F.lit(2.0**-24)
        cell = _bits(h, 20, 10)
        ln_c = F.get(c_table, F.when(cell > 0, cell).otherwise(_bits(h, 10, 10).bitwiseOR(F.lit(CELLS))).cast("int"))
        drawn.append(F.struct(r.alias("r"), beta.alias("beta"), ln_c.alias("c")))
    d = d.select(*keys, "first", "term", "lw", *[v[f].alias(f"{f}{j}") for j, v in enumerate(drawn) for f in ("r", "beta", "c")])
    d = d.select("*", *[F.floor(F.col("lw") / F.col(f"r{j}") + F.col(f"beta{j}")).alias(f"t{j}") for j in range(AT_ONCE)])
    packed = []
    for j in range(AT_ONCE):  # ln a in the high bits, so that a least long is a least a; word and t below
        ln_a = F.col(f"c{j}") - F.col(f"r{j}") * (F.col(f"t{j}").cast("double") - F.col(f"beta{j}") + F.lit(1.0))
        sign = F.shiftrightunsigned("term", 40).bitwiseXOR(_bits(F.col(f"t{j}"), 0, 24))
        packed.append(F.shiftleft(F.floor((ln_a + F.lit(512.0)) * F.lit(float(2**29))), 24).bitwiseOR(sign).alias(f"p{j}"))
    m = d.select(*keys, "first", *packed).groupBy(*keys, "first").agg(*[F.min(f"p{j}").alias(f"m{j}") for j in range(AT_ONCE)])
    places = [(g, j) for g in firsts for j in range(AT_ONCE) if g + j < draws]
    m = m.groupBy(*keys).agg(*[F.max(F.when(F.col("first") == g, F.col(f"m{j}"))).alias(f"d{g + j}") for g, j in places])
    # 1 is added so that 0 stands for a text without words
    return m.select(*keys, F.array(*[_bits(F.col(f"d{k}"), 0, 24) + 1 for k in range(draws)]).alias("samples"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; texts without words are alike."""
    used = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != 0) | (y != 0)), lambda z: z))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != 0)), lambda z: z))
    return F.when(used == 0, 1.0).otherwise(same.cast("double") / used)


def hex_of(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 7, "0")), "")


def bucketed(docs: DataFrame, bucket_docs: int) -> DataFrame:
    """Rows with `bucket` and `own`, dealt by bucket: buckets of adjacent ids, each with a
    copy (own: false) of the document after its last one in descending order of ids.

    A bucket is a part of equal width of the range of ids.  One that holds too many documents,
    as where some ids lie far from the others, is cut again by the range of its own ids.
    """
    docs, n, finer = docs.withColumn("bucket", F.lit(0).cast("long")), 0, 1
    for level in range(LEVELS):
        cells = docs.groupBy("bucket").agg(F.min("doc_id").cast("decimal(20,0)").alias("low"), F.max("doc_id").cast("decimal(20,0)").alias("high"), F.count("*").alias("n"))
        cells = checkpointed(cells.where(F.col("high") > F.col("low")).where(F.col("n") > CROWDED * bucket_docs if level else F.lit(True)))
        many, most = cells.agg(F.count("*"), F.max("n")).first()
        n = n or most or 0
        parts = (most or 0) // bucket_docs + 1
        if not many or finer * parts >= 2**62 // max(n, 1):
            break
        width = F.greatest(F.ceil((F.col("high") - F.col("low") + 1) / (F.floor(F.col("n") / bucket_docs) + 1)), F.lit(1)).cast("decimal(20,0)")
        cells = cells.select("bucket", "low", width.alias("width"))
        inner = F.floor((F.col("doc_id").cast("decimal(20,0)") - F.col("low")) / F.col("width")).cast("long")
        docs = docs.join(F.broadcast(cells) if many <= MAX_BROADCAST else cells, "bucket", "left")
        docs = docs.withColumn("bucket", F.col("bucket") * F.lit(parts) + F.coalesce(inner, F.lit(0))).drop("low", "width")
        finer = finer * parts if level else 1
    heads = docs.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).withColumn("region", F.floor(F.col("bucket") / F.lit(512 * finer)))
    # the next bucket above that isn't empty; beyond the highest comes the lowest
    regions = heads.groupBy("region").agg(F.min("bucket").alias("lowest"))
    above = regions.select("region", F.lead("lowest").over(Window.orderBy("region")).alias("above"), F.min("lowest").over(Window.partitionBy(F.lit(0))).alias("bottom"))
    up = heads.select("doc_id", "region", F.lead("bucket").over(Window.partitionBy("region").orderBy("bucket")).alias("near"))
    up = up.join(above, "region").select("doc_id", F.coalesce("near", "above", "bottom").alias("up"))
    if n // bucket_docs <= MAX_BROADCAST:
        up = F.broadcast(up)
    places = F.array(F.struct(F.col("bucket"), F.lit(True).alias("own")), F.struct(F.col("up").alias("bucket"), F.lit(False).alias("own")))
    rows = docs.join(up, "doc_id", "left").select("doc_id", "text", F.explode(places).alias("p"))
    rows = rows.select("doc_id", "text", "p.bucket", "p.own").where("bucket IS NOT NULL")
    # no lambda below this exchange: its variables would keep the plan from sharing it
    return rows.repartition(2 * partitions_of(docs), "bucket")


def fingerprints(docs: DataFrame, draws: int = DRAWS, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    docs = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    order = Window.partitionBy("bucket").orderBy(F.desc("own"), F.desc("doc_id"), "text")
    rows = bucketed(docs, bucket_docs).select("bucket", "own", "doc_id", "text", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring("next", F.lit(1), half))
    rows = rows.select("bucket", "own", "doc_id", "rn", F.length("text").cast("long").alias("n_chars"), "text", F.when(F.col("own"), edited).alias("edited"))
    facts = rows.select("bucket", "own", "doc_id", "rn", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    texts = rows.select("bucket", "rn", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("x"))
    words = texts.select("bucket", "rn", "x.side", F.explode(F.split("x.t", r"[\x20\x09-\x0D]+")).alias("w")).where("w <> ''")
    keys = ["bucket", "rn", "side"]
    counts = words.select(*keys, F.xxhash64("w").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("weight"))
    s = samples(counts, keys, draws)
    none = F.array_repeat(F.lit(0).cast("long"), draws)
    both = s.groupBy("bucket", "rn").agg(F.max(F.when(F.col("side") == 0, F.col("samples"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("samples"))).alias("b"))
    all_ = facts.join(both, ["bucket", "rn"], "left").select("bucket", "own", "doc_id", "rn", "n_chars", "edited_sha256", F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    out = all_.select("*", F.lead("a").over(Window.partitionBy("bucket").orderBy("rn")).alias("after")).where("own")
    return out.select("doc_id", "n_chars", "edited_sha256", hex_of(F.col("a")).alias("fingerprint"), hex_of(F.col("b")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("after")).alias("near_next"))
