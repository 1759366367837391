"""Text helpers as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def u(pattern: str, flags: str = "") -> str:
    """A pattern with Unicode white space and \\n as the only line end."""
    return f"(?Ud{flags}){pattern}"


def in_line(pattern: str) -> str:
    """A pattern of a line as a part of a pattern of whole texts: no anchor at the start, and
    white space that stays in the line."""
    return pattern.replace("^", "").replace(r"\s", BLANKS)


BLANKS = r"[^\S\n]"  # white space but the newline


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `x`, with `x` written into the plan and evaluated once."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def strip(x: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(x, u(r"^\s+|\s+$"), "")


def normalised(x: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(x, u(r"\s+"), " "))


def window(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def lines(x: Column) -> Column:
    return F.split(x, "\n", -1)


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.get(F.filter(F.array(F.regexp_extract(x, u(pattern), group)), lambda m: m != ""), F.lit(0))


def all_found(x: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(x, F.lit(u(pattern)), F.lit(group))


def joined(x: Column) -> Column:
    """A list as text, for comparison and display."""
    return F.array_join(x, "|")


def lookup(table: dict[str, str], key: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in reversed(table.items()):
        out = F.when(key == k, v).otherwise(out)
    return out
