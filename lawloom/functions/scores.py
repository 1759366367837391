"""Scores of an extraction, and the comparison of two."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import u


def _some(x: Column) -> Column:
    return F.coalesce(x.isNotNull() & (x != ""), F.lit(False))


def _any(x: Column) -> Column:
    return F.coalesce(F.size(x) > 0, F.lit(False))


def has_title(x: Column) -> Column:
    return _some(x) & (x != "Unknown Title")


def metadata_score(d: dict[str, Column]) -> Column:
    """How many of seven fields were found."""
    tests = [_some(d["bill_id"]), _some(d["session"]), F.coalesce(has_title(d["title"]), F.lit(False)), _any(d["sponsors"]), _some(d["committee"]), d["introduced_date"].isNotNull(), _any(d["amended_code_refs"])]
    return sum((t.cast("int") for t in tests), F.lit(0))


def cleanliness(body: Column) -> Column:
    """100 less a penalty for each trace of page furniture, at least 0."""
    count = lambda p: F.regexp_count(body, F.lit(u(p))).cast("double")
    penalty = count(P.STRAY_NUMBERS) * 0.5 + count(P.PAGE_HEADERS) * 2.0 + count(P.PAGE_NUMBERS) + count(P.DISCLAIMERS) * 2.0
    return F.greatest(F.lit(0.0), F.lit(100.0) - penalty)


def report_line(meta: Column, clean: Column, conf: Column) -> Column:
    return F.format_string("Metadata: %d/7, Cleanliness: %.1f/100, Confidence: %.2f", meta, clean, conf)


def accepted(meta: Column, clean: Column, conf: Column) -> Column:
    """Whether deltas are an improvement: nothing lost, and something gained."""
    return (meta >= 0) & (clean >= -5.0) & ((meta > 0) | (clean > 5.0) | (conf > 0.05))


def reasoning(meta: Column, clean: Column, conf: Column) -> Column:
    # The wording of the reasons, which results must match.
    gains = F.concat_ws(
        ", ",
        F.when(meta > 0, F.format_string("+%d metadata fields", meta)),
        F.when(clean > 5.0, F.format_string("+%.1f cleanliness", clean)),
        F.when(conf > 0.05, F.format_string("+%.2f confidence", conf)),
    )
    return (
        F.when(meta < 0, "Metadata regression: lost extracted fields")
        .when(clean < -5.0, F.format_string("Text cleanliness regression: %.1f", clean))
        .when(gains != "", gains)
        .otherwise("No measurable improvement")
    )


def accepted_strictly(meta: Column, clean: Column) -> Column:
    """The former rule: any loss rejects, any gain accepts."""
    return (meta >= 0) & (clean >= 0) & ((meta > 0) | (clean > 0))


def field_status(before: Column, after: Column) -> Column:
    """Equal, newly filled, changed or lost, of fields as text (null: absent)."""
    blank = lambda x: x.isNull() | (x == "")
    return F.when(before.eqNullSafe(after), "—").when(blank(before) & ~blank(after), "✅").when(~blank(before) & ~blank(after), "🔄").otherwise("—")
