"""Aggregates over extractions: rates, gates, comparisons and summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scores

# Least rates of the quality gate.
GATES = {"sponsor_rate": 0.60, "committee_rate": 0.60, "session_rate": 0.95}


DELTAS = ("metadata_delta", "cleanliness_delta", "confidence_delta")


def scored(docs: DataFrame) -> DataFrame:
    """Documents with their metadata and cleanliness scores."""
    d = {c: F.col(c) for c in docs.columns}
    return docs.select("*", scores.metadata_score(d).alias("metadata_score"), scores.cleanliness(F.col("body_text")).alias("cleanliness_score"))


def _rates() -> list[Column]:
    good = F.col("error").isNull()
    share = lambda test: F.avg(F.when(good, F.coalesce(test, F.lit(False)).cast("double")))
    text = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return [
        F.count("*").alias("total_bills"),
        F.count_if(good).alias("successful_extractions"),
        share(text("bill_id")).alias("bill_id_rate"),
        share(text("session")).alias("session_rate"),
        share(scores.has_title(F.col("title"))).alias("title_rate"),
        share(F.size("sponsors") > 0).alias("sponsor_rate"),
        F.avg(F.when(good, F.size("sponsors").cast("double"))).alias("avg_sponsors"),
        share(text("committee")).alias("committee_rate"),
        share(F.size("amended_code_refs") > 0).alias("code_ref_rate"),
        F.avg(F.when(good, F.col("extraction_confidence"))).alias("avg_confidence"),
    ]


def quality_rates(docs: DataFrame, *by: str) -> DataFrame:
    """Shares of the successful extractions with each field, over all or by group.

    `docs` may have an `error` column; without one all rows are successes.
    """
    docs = docs if "error" in docs.columns else docs.withColumn("error", F.lit(None).cast("string"))
    return docs.groupBy(*by).agg(*_rates())


def gated(rates: DataFrame, gates: dict[str, float] | None = None) -> DataFrame:
    """Whether each rate reaches its gate, and all do."""
    gates = gates or GATES
    passed = {k.replace("_rate", "_ok"): F.col(k) >= F.lit(v) for k, v in gates.items()}
    out = rates.select("*", *[v.alias(k) for k, v in passed.items()])
    every = F.lit(True)
    for k in passed:
        every = every & F.col(k)
    return out.withColumn("gate_passed", every)


def compared(base: DataFrame, improved: DataFrame, key: str) -> DataFrame:
    """Deltas of two scored versions of the same documents, with verdict and reason."""
    fields = ["metadata_score", "cleanliness_score", "extraction_confidence"]
    a = base.select(key, *[F.col(c).alias(f"a_{c}") for c in fields])
    b = improved.select(key, *[F.col(c).alias(f"b_{c}") for c in fields])
    d = a.join(b, key).select(key, *[(F.col(f"b_{c}") - F.col(f"a_{c}")).alias(n) for c, n in zip(fields, DELTAS, strict=True)])
    return judged(d)


def compared_within(docs: DataFrame, before: Column, after: Column, *keys: str) -> DataFrame:
    """The same for two documents of one row (structs such as `bill_versions` makes), no join."""
    score = lambda d: (scores.metadata_score({c: d[c] for c in ("bill_id", "session", "title", "sponsors", "committee", "introduced_date", "amended_code_refs")}), scores.cleanliness(d["body_text"]), d["extraction_confidence"])
    deltas = [(b - a).alias(n) for a, b, n in zip(score(before), score(after), DELTAS, strict=True)]
    return judged(docs.select(*keys, *deltas))


def judged(deltas: DataFrame) -> DataFrame:
    """Rows of deltas with verdict and reason."""
    d = [F.col(c) for c in DELTAS]
    return deltas.select("*", scores.accepted(*d).alias("accepted"), scores.reasoning(*d).alias("reasoning"))


def accept_summary(results: DataFrame) -> DataFrame:
    """Accepted, total, success rate in percent, and mean deltas (absent ones count as 0)."""
    mean = lambda c: F.avg(F.coalesce(c, F.lit(0)).cast("double"))
    return results.agg(
        F.count("*").alias("total"),
        F.count_if("accepted").alias("n_accepted"),
        F.coalesce(100.0 * F.count_if("accepted") / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("success_rate"),
        mean("metadata_delta").alias("avg_metadata_delta"),
        mean("cleanliness_delta").alias("avg_cleanliness_delta"),
        mean("confidence_delta").alias("avg_confidence_delta"),
    )


def best_iteration(results: DataFrame, order: str) -> DataFrame:
    """The row of the highest metadata delta plus a tenth of the cleanliness delta; the first wins."""
    score = F.col("metadata_delta") + F.col("cleanliness_delta") / 10
    return results.withColumn("score", score.cast("double")).orderBy(F.desc("score"), order).limit(1)


def distinct_sponsors(docs: DataFrame) -> DataFrame:
    """Each sponsor once, and whether a word in it can't be a name."""
    names = docs.select(F.explode("sponsors").alias("sponsor")).distinct()
    bad = F.arrays_overlap(F.split("sponsor", " "), F.array(*map(F.lit, P.NOT_NAMES)))
    return names.select("sponsor", bad.alias("suspicious"))


def flagged(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents of low confidence, or without a title or session (planned flags)."""
    low = (F.col("extraction_confidence") < least) | F.col("title").isNull() | F.col("session").isNull()
    return docs.withColumn("low_quality", low)


def without_resolves(docs: DataFrame) -> DataFrame:
    """Resolves name no sponsor; sponsor rates leave them out."""
    return docs.where(~F.coalesce(F.col("title").contains("Resolve"), F.lit(False)))


def gate_measures() -> dict[str, Column]:
    """What the gate's rates over records are means of, so that they can be observed while the
    records are written (a record's session comes from its file name; its rate isn't among them)."""
    given = lambda test: F.coalesce(test, F.lit(False)).cast("double")
    return {"sponsor_rate": given(F.size("sponsors") > 0), "committee_rate": given(F.col("committee") != ""), "title_rate": given(scores.has_title(F.col("title"))), "avg_confidence": F.col("extraction_confidence")}


def below_gate(rates: Mapping[str, float | None], gates: Mapping[str, float] | None = None) -> dict[str, float]:
    """The rates that miss their gates; absent ones (no rows) aren't judged."""
    return {k: rates[k] for k, least in (gates or GATES).items() if rates.get(k) is not None and rates[k] < least}


def test_tokens(lines: DataFrame, column: str = "line") -> DataFrame:
    """PASSED and FAILED tokens of a test log (a failure is printed twice and counts twice)."""
    return lines.agg(F.sum(F.regexp_count(column, F.lit("PASSED"))).alias("n_passed"), F.sum(F.regexp_count(column, F.lit("FAILED"))).alias("n_failed"))
