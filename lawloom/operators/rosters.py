"""Sponsors against a roster of known names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL = 5_000  # names up to which the roster is an array in the plan


def validate_sponsors(docs: DataFrame, known: DataFrame | None, column: str = "sponsors", name: str = "last_name") -> DataFrame:
    """Keep the sponsors whose upper-case form is known, in order and as written; null stays null.

    No roster leaves all; an empty one removes all.  A small roster (counted, never more than
    SMALL names) is a literal of the plan; with a larger one each different list is judged once
    by a join, and the answers are joined back by the list itself.
    """
    if known is None:
        return docs
    names = [r[0] for r in known.select(name).distinct().limit(SMALL + 1).collect()]
    if len(names) <= SMALL:
        listed = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        return docs.withColumn(column, F.filter(column, lambda s: F.array_contains(listed, F.upper(s))))
    lists = docs.select(F.col(column).alias("_list")).where(F.size("_list") > 0).distinct()
    hits = lists.select("_list", F.posexplode("_list").alias("_pos", "_s")).join(known.select(F.col(name).alias("_known")).distinct(), F.upper("_s") == F.col("_known"), "left_semi")
    kept = hits.groupBy("_list").agg(F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_s"))), lambda x: x["_s"]).alias("_kept"))
    some = F.when(F.col(column).isNotNull(), F.coalesce("_kept", F.array().cast("array<string>")))
    return docs.join(kept, F.col(column) == F.col("_list"), "left").select(*[some.alias(c) if c == column else F.col(c) for c in docs.columns])


def _plain(c: str):
    return F.upper(F.regexp_replace(F.col(c), r"[^A-Za-z]", ""))


def link_exactly(sponsors: DataFrame, roster: DataFrame) -> DataFrame:
    """Each sponsor with the legislators of the same plain name; ambiguous if there are several."""
    r = roster.select("legislator_id", _plain("last_name").alias("plain"))
    n = r.groupBy("plain").agg(F.count("*").alias("n_matches"), F.min("legislator_id").alias("legislator_id"))
    s = sponsors.select("sponsor", _plain("sponsor").alias("plain"))
    return s.join(n, "plain", "left").select("sponsor", "legislator_id", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.coalesce(F.col("n_matches") > 1, F.lit(False)).alias("ambiguous"))


def deletions(name: Column, most: int) -> Column:
    """The name, and all it becomes by the deletion of up to `most` letters, as 64-bit hashes."""
    forms = F.array(name)
    without = lambda s: F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)))
    for _ in range(most):
        shorter = F.flatten(F.transform(F.filter(forms, lambda s: s != ""), without))
        forms = F.array_distinct(F.concat(forms, shorter))
    return F.transform(forms, lambda s: F.xxhash64(s))


def near_matches(sponsors: DataFrame, roster: DataFrame, most: int = 2) -> DataFrame:
    """Each sponsor without an exact match, and its nearest legislators within `most` edits:
    legislator_id (the least of them), distance, n_matches (how many are as near), ambiguous.
    A sponsor without any has nulls and 0.

    Two names within k edits become equal by the deletion of up to k letters from each.  So the
    hashes of these forms are equi-joined, about n^k / k! a name, and the candidates verified.
    Sponsors that are longer than the longest name by more than `most` letters have no match
    and take no part.
    """
    left = link_exactly(sponsors, roster).where("n_matches = 0").select("sponsor", _plain("sponsor").alias("a")).distinct()
    right = roster.select("legislator_id", _plain("last_name").alias("b"))
    longest = roster.agg(F.coalesce(F.max(F.length("last_name")), F.lit(0)).alias("n")).first()["n"]
    names = right.where("b <> ''").groupBy("b").agg(F.min("legislator_id").alias("legislator_id"), F.count("*").alias("n"))
    asked = left.where((F.col("a") != "") & (F.length("a") <= longest + most)).select("a").distinct()
    pairs = asked.select("a", F.explode(deletions(F.col("a"), most)).alias("form")).join(names.select("b", "legislator_id", "n", F.explode(deletions(F.col("b"), most)).alias("form")), "form")
    near = pairs.select("a", "b", "legislator_id", "n").distinct().withColumn("distance", F.levenshtein("a", "b")).where(F.col("distance") <= most)
    best = near.groupBy("a", "distance").agg(F.min("legislator_id").alias("legislator_id"), F.sum("n").alias("n"))
    best = best.groupBy("a").agg(F.min(F.struct("distance", "legislator_id", "n")).alias("m"))
    found = left.join(best, "a", "left")
    n = F.coalesce("m.n", F.lit(0)).cast("long")
    return found.select("sponsor", F.col("m.legislator_id").alias("legislator_id"), F.col("m.distance").alias("distance"), n.alias("n_matches"), (n > 1).alias("ambiguous"))


def link_nearly(sponsors: DataFrame, roster: DataFrame, most: int = 2) -> DataFrame:
    """The sponsors without an exact match that have a near one."""
    return near_matches(sponsors, roster, most).where("n_matches > 0").select("sponsor", "legislator_id", "distance")


def unmatched(sponsors: DataFrame, roster: DataFrame, most: int = 2) -> DataFrame:
    """The sponsors with neither an exact nor a near match."""
    return near_matches(sponsors, roster, most).where("n_matches = 0").select("sponsor")


def match_rate(linked: DataFrame) -> DataFrame:
    return linked.agg(F.count("*").alias("n_sponsors"), F.count_if(F.col("n_matches") > 0).alias("n_linked"), F.count_if(F.col("ambiguous")).alias("n_ambiguous"))
