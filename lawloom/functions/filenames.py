"""File names such as 131-LD-0686-CA_A_H0266."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMENDMENT_TYPES, CHAMBERS, DOCUMENT_TYPES
from .patterns import CHAMBER, FILENAME
from .text import lookup


def is_valid(name: Column) -> Column:
    return name.rlike(FILENAME)


def _group(name: Column, k: int) -> Column:
    return F.nullif(F.regexp_extract(name, FILENAME, k), F.lit(""))


def parsed(name: Column, strict: bool = False) -> dict[str, Column]:
    """The parts of a file name; null for an invalid one, or an error if strict."""
    code = _group(name, 4)
    kind = F.split(code, "_").getItem(0)
    session = _group(name, 1).cast("int")
    if strict:
        session = F.when(is_valid(name), session).otherwise(F.raise_error(F.concat(F.lit("Unexpected filename format: "), F.coalesce(name, F.lit("null")))).cast("int"))
    return {
        "session": session,
        "ld_number": _group(name, 3),
        "bill_type": _group(name, 2),
        "document_type": lookup(DOCUMENT_TYPES, _group(name, 2)),
        "amendment_code": code,
        "amendment_type": F.coalesce(lookup(AMENDMENT_TYPES, kind), kind),
        "chamber": lookup(CHAMBERS, F.nullif(F.regexp_extract(code, CHAMBER, 1), F.lit(""))),
    }


def is_base_bill(name: Column, lenient: bool = False) -> Column:
    """No amendment suffix; lenient: an underscore in the last part is one too."""
    base = parsed(name)["amendment_code"].isNull()
    return base & ~F.element_at(F.split(name, "-"), -1).contains("_") if lenient else base


def source_url(base: str, name: Column) -> Column:
    return F.concat(F.lit(base), name, F.lit(".pdf"))
