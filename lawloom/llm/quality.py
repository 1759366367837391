"""Quality rules: a table of thresholds compiled into one projection, no user functions.

Each rule names a metric, its allowed range, and the least number of words from which it
applies (ratios of very short texts say little).  Metrics are plain column expressions, so
the whole operator is one scan and one chain of projections without a shuffle.

Defined results: a null text has no words and lines; a text without words fails the base
rule; a ratio that equals its threshold passes; repeated rows are judged alike and all
returned, rows without a doc_id too; very long texts are measured whole; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages the rules were written for.
STOP_WORDS = {
    "en": "the of and a to in is was that it for on with as by at from or an are this be not which but only".split(),
    "fr": "le la les de des du un une et en est que qui dans pour par sur pas au aux ce il elle on ne".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "es": "el la los las de del que y en un una por con no se su para es al lo como más o pero sus".split(),
}
SPACE = r"[\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


RULES = (
    Rule("few_words", "n_words", low=10),
    Rule("mean_word_length", "mean_word_chars", low=2.0, high=25.0, min_words=10),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("shouting", "upper_ratio", high=0.4, min_words=10),
    Rule("marks", "mark_ratio", high=0.3, min_words=10),
    Rule("no_stop_words", "stop_ratio", low=0.01, min_words=150),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("bullets", "bullet_ratio", high=0.9, min_words=10),
)


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id with counts and ratios of the whole text, all as built-in expressions."""
    stops = [F.xxhash64(F.lit(x)) for x in sorted({x for ws in STOP_WORDS.values() for w in ws for x in (w, w.capitalize())})]
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.select("*", F.btrim("text", F.lit(" \t\n\x0b\x0c\r")).alias("bare"))
    d = d.select(
        "doc_id",
        "text",
        F.when(F.col("bare") == "", F.array().cast("array<string>")).otherwise(F.split("bare", SPACE + "+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    left = lambda chars: F.length(F.regexp_replace("text", f"[^{chars}]+", ""))  # noqa: E731  characters of a class
    d = d.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        left("#*$%&|<>").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        left("A-Z").alias("n_upper"),
        left("!?").alias("n_marks"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•·–]"))).alias("n_bullets"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    d = d.select("*", F.size(F.filter("h", lambda x: x.isin(stops))).alias("n_stop"))
    return repeated_words(d)


def repeated_words(d: DataFrame, width: int = 5) -> DataFrame:
    """n_repeat_words: words in windows of `width` words that the text holds twice or more."""
    at = lambda i, k: F.get("h", i + k)
    d = d.select(
        "*",
        F.when(
            F.size("h") >= width,
            F.transform(F.sequence(F.lit(0), F.size("h") - width), lambda i: F.xxhash64(*[at(i, k) for k in range(width)])),
        )
        .otherwise(F.array().cast("array<long>"))
        .alias("win"),
    ).drop("h")
    d = d.select("*", (F.size(F.array_distinct("win")) < F.size("win")).alias("has_repeat"))
    d = d.select("*", F.when(F.col("has_repeat"), F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("ordered")).drop("win")
    same = lambda s, k: F.get("ordered", k)["h"] == s["h"]
    again = F.filter("ordered", lambda s, k: F.coalesce((k > 0) & same(s, F.greatest(k - 1, F.lit(0))), F.lit(False)) | F.coalesce(same(s, k + 1), F.lit(False)))
    d = d.select("*", F.when(F.col("has_repeat"), F.sort_array(F.transform(again, lambda s: s["i"]))).alias("at")).drop("ordered")
    gap = lambda k: F.least(F.lit(width), F.get("at", k) - F.get("at", k - 1))
    covered = F.lit(width) + F.aggregate(F.sequence(F.lit(1), F.size("at") - 1), F.lit(0), lambda a, k: a + gap(k))
    return d.select("*", F.when(F.col("has_repeat"), covered).otherwise(0).cast("long").alias("n_repeat_words")).drop("at", "has_repeat")


def ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "upper_ratio": ("n_upper", "word_chars"),
    "mark_ratio": ("n_marks", "n_words"),
    "stop_ratio": ("n_stop", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "bullet_ratio": ("n_bullets", "n_lines"),
}


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The names of the rules that a row breaks, in the table's order, as one expression."""
    broken = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (F.col(r.metric) < r.low)
        if r.high is not None:
            bad = bad | (F.col(r.metric) > r.high)
        broken.append(F.when(bad & (F.col("n_words") >= r.min_words), F.lit(r.name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: counts, ratios, `base_failed`, `broken` rules and `kept`."""
    m = metrics(docs).select("*", *[ratio(*ab).alias(k) for k, ab in RATIOS.items()])
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    m = m.select("*", base.alias("base_failed"), compile_rules(rules).alias("broken"))
    return m.select("*", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"))
