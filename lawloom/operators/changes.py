"""What a new set of rows changes in an old one, by key and digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("insert", "change", "vanish", "same")


def digest(*columns: str) -> Column:
    """SHA-256 of columns as JSON."""
    # JSON leaves a null field out, so null, '' and 'null' differ
    return F.sha2(F.concat_ws("\x1f", *[F.to_json(F.struct(F.col(c).alias("v"))) for c in columns]), 256)


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each key: the last by `order` (nulls first).  An aggregate, not a window, so
    that repeats are dropped before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order]))
    return rows.groupBy(key).agg(best.alias("_last")).select(*[F.col(f"_last.{c}").alias(c) if c != key else F.col(key) for c in rows.columns])


def merged(before: DataFrame, now: DataFrame, key: str, digest: str = "digest", complete: Column | None = None) -> DataFrame:
    """The columns of `now` and `action`: the row that holds after `now` has been applied.

    insert: a new key; change: another digest, the new row holds; same: equal digests, the old
    row holds with all it had; vanish: a key that `now` lacks where `complete` (of the old row;
    by default nowhere), with its old row; other keys that `now` lacks are the same.
    Both sides have a row for each key at most.
    """
    columns = now.columns
    gone = F.lit(False) if complete is None else F.coalesce(complete, F.lit(False))
    a = before.select(F.struct(*columns).alias("_old"), F.col(key).alias("_key"), gone.alias("_gone"))
    b = now.select(F.struct(*columns).alias("_new"), F.col(key).alias("_key"))
    both = a.join(b, "_key", "full_outer")
    old, new = F.col("_old"), F.col("_new")
    action = F.when(old.isNull(), "insert").when(new.isNull(), F.when(F.col("_gone"), "vanish").otherwise("same")).when(old[digest].eqNullSafe(new[digest]), "same").otherwise("change")
    row = F.when(action.isin("insert", "change"), new).otherwise(old)
    return both.select(action.alias("action"), row.alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in columns], "action")


def change_table(before: DataFrame, now: DataFrame, key: str, digest: str = "digest") -> DataFrame:
    """key, action, and the digests of both sides, of the keys that differ; `now` is complete."""
    a, b = (d.select(F.col(key), F.col(digest).alias(n)) for d, n in ((before, "before"), (now, "after")))
    action = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "vanish").otherwise("change")
    return a.join(b, key, "full_outer").where(~F.col("before").eqNullSafe(F.col("after"))).select(key, action.alias("action"), "before", "after")
