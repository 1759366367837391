"""Mixing sources to target weights by iterative proportional fitting.

The corpus is aggregated once to cells (source, language, topic) of token counts.  Raking
scales the cell weights until their sums over each dimension meet the target shares; the
sampling probabilities are calibrated so that the expected kept tokens meet the budget with
no probability above one; a document is kept if a hash of its id lies below its cell's
probability, so a rerun or a lost executor gives the same sample.

Defined results: null sources, languages and topics are values of their own; a null or
blank text has no tokens and its document is in its cell; a cell without tokens keeps its
documents (nothing is gained by dropping them); rows with equal ids are kept or dropped
together if their cells agree, so repeated rows are; of topics that fit the first listed counts;
very long texts are counted whole; an empty table gives an empty result; rows without a doc_id
are all sampled by one number; columns named topic, n_tokens, weight, probability or sampled
are replaced, others stay.
"""

from __future__ import annotations

import warnings
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, driver_rows

DIMS = ("source", "lang", "topic")
MAX_CELLS = 200_000  # cells raked on the driver, and broadcast; more are raked by Spark
ROUNDS, TOLERANCE = 200, 1e-9  # raking stops when no sum is further off than this, or warns at the limit
NULL = "\u0000null"


def n_tokens(text: Column) -> Column:
    """Words of the text (runs without space and 0x09-0x0D)."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic from the form of the text; give a `topic` column to use another one."""
    t = F.coalesce(text, F.lit(""))
    has = lambda *parts: reduce(or_, [t.contains(p) for p in parts])  # noqa: E731  plain byte searches
    rules = [
        ("secrets", has("password=", "password:", "token =", "secret=", "AKIA")),
        ("licence", has("License", "Licence", "license", "licence", "Copyright", "All rights reserved")),
        ("contact", has("@", " +")),
        ("tabular", has(" | ")),
        ("markup", has("##", "**", "$$", "%%", "&&", "</")),
        ("shouting", has("!!")),
        ("figures", t.rlike("[0-9]{4}")),
        ("long_form", F.length(t) > 8000),
    ]
    out = F.lit("prose")
    for name, test in reversed(rules):
        out = F.when(test, name).otherwise(out)
    return out


def rake(codes: np.ndarray, mass: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS, tol: float = TOLERANCE) -> np.ndarray:
    """Weights of cells (codes: dims x cells) whose sums over each dimension meet `targets`.

    Marginals that no weights can meet at once, or not within `rounds`, end there with a warning.
    """
    w = mass / max(mass.sum(), 1e-300)
    for _ in range(rounds):
        worst = 0.0
        for code, target in zip(codes, targets, strict=True):
            have = np.bincount(code, w, len(target))
            scale = np.where(have > 0, target / np.where(have > 0, have, 1), 1.0)
            worst = max(worst, float(np.abs(scale - 1).max(initial=0)))
            w = w * scale[code]
        if worst < tol:
            break
    else:
        _not_met(rounds, worst)
    return w


def _not_met(rounds: int, worst: float) -> None:
    warnings.warn(f"raking stopped after {rounds} rounds with a marginal scaled by {worst:.2g} in the last one", RuntimeWarning, stacklevel=3)


def goals_of(cells: DataFrame, dim: str, alpha: float, given: dict[str, float] | None) -> DataFrame:
    """(dim, goal): the given shares, 0 for values without one, or the tempered own shares."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("have"))
    if given is not None:
        rows = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], f"{dim} string, goal double")
        return sums.join(rows, dim, "left").select(dim, F.coalesce("goal", F.lit(0.0)).alias("goal"))
    up = sums.select(dim, F.when(F.col("have") > 0, F.pow("have", F.lit(alpha))).otherwise(0.0).alias("up"))
    total = up.agg(F.sum("up")).first()[0] or 1.0
    return up.select(dim, (F.col("up") / F.lit(total)).alias("goal"))


def rake_cells(cells: DataFrame, goals: dict[str, DataFrame], rounds: int = ROUNDS, tol: float = TOLERANCE) -> DataFrame:
    """The same in Spark, for more cells than MAX_CELLS, and stopped by the same rule: each step
    is an aggregation by one dimension and a join back (skewed values split by AQE); the scales
    of each step are checkpointed, and the cells each round."""
    cells = cells.withColumn("w", F.col("tokens").cast("double")).withColumn("off", F.lit(0.0))
    for d in DIMS:
        cells = cells.join(goals[d].withColumnRenamed("goal", f"goal_{d}"), d, "left")
    cells = checkpointed(cells)
    for _ in range(rounds):
        cells = cells.withColumn("off", F.lit(0.0))
        for d in DIMS:
            have = cells.groupBy(d).agg(F.sum("w").alias("have"), F.max(f"goal_{d}").alias("goal"))
            scale = checkpointed(have.select(d, F.when((F.col("have") > 0) & F.col("goal").isNotNull(), F.col("goal") / F.col("have")).otherwise(1.0).alias("scale")))
            cells = cells.join(scale, d).withColumn("w", F.col("w") * F.col("scale")).withColumn("off", F.greatest("off", F.abs(F.col("scale") - 1))).drop("scale")
        cells = checkpointed(cells)
        worst = cells.agg(F.max("off")).first()[0] or 0.0
        if worst < tol:
            break
    else:
        _not_met(rounds, worst)
    return cells.drop("off", *[f"goal_{d}" for d in DIMS])


def calibrate(w: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """p = min(1, c * w / tokens) with c such that sum(p * tokens) is the budget: cells that
    reach one are fixed there and the rest is scaled again (sorted, so one pass)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(w > 0, tokens / w, np.inf)  # c at which the cell is full
    order = np.argsort(need, kind="stable")
    full_before = np.concatenate([[0.0], np.cumsum(tokens[order])[:-1]])
    rest = np.cumsum(w[order][::-1])[::-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        c = np.where(rest > 0, (budget - full_before) / rest, np.inf)
        fits = np.flatnonzero((c <= need[order]) & np.isfinite(c))
    scale = c[fits[0]] if len(fits) else np.inf
    with np.errstate(invalid="ignore"):
        p = np.where(tokens > 0, np.where(w > 0, np.minimum(1.0, scale * w / np.maximum(tokens, 1e-300)), 0.0), 1.0)
    return np.clip(p, 0.0, 1.0)


def mix_to_targets(
    docs: DataFrame,
    alphas: dict[str, float] | None = None,
    targets: dict[str, dict[str, float]] | None = None,
    keep: float = 0.5,
    seed: int = 42,
    max_cells: int = MAX_CELLS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """docs' columns plus topic, n_tokens, weight (of a token), probability and sampled.

    targets: shares by value for each dimension; those not given are the corpus' own shares
    to the power alphas[dimension].  keep: expected share of the corpus' tokens that stays.
    """
    alphas = {"source": 0.5, "lang": 0.7, "topic": 0.7} | (alphas or {})
    spark, own = docs.sparkSession, [c for c in docs.columns]
    topic = F.col("topic").cast("string") if "topic" in own else topic_of(F.col("text").cast("string"))
    named = {"source": F.col("source").cast("string"), "lang": F.col("lang").cast("string"), "topic": topic}
    tag = {d: f"_mix_{d}" for d in DIMS}
    full = docs.select("*", *[F.coalesce(named[d], F.lit(NULL)).alias(tag[d]) for d in DIMS], n_tokens(F.col("text").cast("string")).alias("_mix_tokens"))
    cells = full.groupBy(*[F.col(tag[d]).alias(d) for d in DIMS]).agg(F.sum("_mix_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    cells = checkpointed(cells)
    goals = {d: goals_of(cells, d, alphas[d], (targets or {}).get(d)) for d in DIMS}
    if cells.count() <= max_cells:
        rows = cells.collect()
        index = {d: {v: i for i, v in enumerate(sorted({r[d] for r in rows}))} for d in DIMS}
        codes = np.array([[index[d][r[d]] for r in rows] for d in DIMS], np.int64).reshape(len(DIMS), -1)
        tokens = np.array([float(r["tokens"]) for r in rows])
        shares = []
        for d in DIMS:
            have = {r[0]: r[1] for r in goals[d].collect()}
            shares.append(np.array([have[v] for v in index[d]]))
        w = rake(codes, tokens, shares, rounds)
        p = calibrate(w, tokens, keep * tokens.sum())
        out = [(*[r[d] for d in DIMS], float(a / t) if t else 0.0, float(b)) for r, a, t, b in zip(rows, w, tokens, p, strict=True)]
        plan = F.broadcast(driver_rows(spark, out, pa.schema([(d, pa.string()) for d in DIMS] + [("weight", pa.float64()), ("probability", pa.float64())])))
    else:
        raked = rake_cells(cells, goals, rounds)
        scale = _scale(raked, keep)
        plan = raked.select(*DIMS, F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0).alias("weight"), F.when((F.col("tokens") > 0) & (F.col("w") > 0), F.least(F.lit(1.0), scale * F.col("w") / F.col("tokens"))).when(F.col("tokens") > 0, 0.0).otherwise(1.0).alias("probability"))
    plan = plan.select(*[F.col(d).alias(tag[d]) for d in DIMS], F.col("weight").alias("_mix_weight"), F.col("probability").alias("_mix_p"))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") * F.lit(2.0**-53)
    joined = full.join(plan, [tag[d] for d in DIMS], "left")
    extra = {"topic": F.when(F.col(tag["topic"]) != NULL, F.col(tag["topic"])), "n_tokens": F.col("_mix_tokens"), "weight": F.col("_mix_weight"), "probability": F.col("_mix_p"), "sampled": u < F.col("_mix_p")}
    return joined.select(*[F.col(c) for c in own if c not in extra], *[v.alias(k) for k, v in extra.items()])


def _scale(raked: DataFrame, keep: float) -> float:
    """c of `calibrate` when the cells stay in Spark: cells that are full at c are fixed and c is
    found anew from the rest.  It only grows, so this ends after a few aggregates."""
    budget, c = keep * float(raked.agg(F.sum("tokens")).first()[0] or 0), 0.0
    while True:
        full = F.col("w") * F.lit(c) >= F.col("tokens")
        used, rest = raked.agg(F.sum(F.when(full, F.col("tokens").cast("double"))), F.sum(F.when(~full, F.col("w")))).first()
        if not rest:
            return float("inf") if (used or 0.0) < budget * (1 - 1e-12) else c
        more = (budget - (used or 0.0)) / rest
        if more <= c * (1 + 1e-12):
            return c
        c = more
