"""Choosing rows: increments, base bills, samples and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import filenames


def valid_filenames(df: DataFrame, column: str = "filename") -> DataFrame:
    return df.where(filenames.is_valid(F.col(column)))


def filename_counts(df: DataFrame, column: str = "filename") -> DataFrame:
    ok = F.coalesce(filenames.is_valid(F.col(column)), F.lit(False))
    return df.agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_skipped"))


def not_yet(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key isn't done yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def base_bills(df: DataFrame, column: str = "filename") -> DataFrame:
    """Valid names without an amendment; if there are none, all valid ones."""
    valid = df.where(filenames.is_valid(F.col(column)))
    base = valid.where(filenames.is_base_bill(F.col(column)))
    return valid if base.isEmpty() else base


def sample(df: DataFrame, n: int, order: str, first: int | None = 100, seed: int = 0) -> DataFrame:
    """n rows, drawn by a digest of the seed and `order`, of the first `first` by `order`."""
    head = df.orderBy(order).limit(first) if first else df
    return head.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(order).cast("string")).cast("binary")), order).limit(n)


def previews(df: DataFrame, column: str) -> DataFrame:
    """Heads of several lengths, a range of lines and a range of characters."""
    text = F.col(column)
    heads = [F.substring(text, 1, n).alias(f"head_{n}") for n in (400, 500, 800, 2000)]
    return df.select("*", *heads, F.array_join(F.slice(F.split(text, "\n", -1), 101, 30), "\n").alias("lines_100_130"), F.substring(text, 1001, 1000).alias("chars_1000_2000"))
