"""From raw text to documents and records: one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning, extract, filenames
from ..functions.text import let
from ..schemas import BILL_DOCUMENT, BILL_RECORD

Extractor = Callable[[Column], Column]

#: Versions of the extractors; a version gives those that differ from the standard ones.
STANDARD: dict[str, Extractor] = {
    "bill_id": extract.bill_id,
    "title": extract.title,
    "session": extract.session,
    "sponsors": extract.sponsors,
    "introduced_date": extract.introduced_date,
    "committee": extract.committee,
    "amended_code_refs": extract.code_refs,
    "body_text": cleaning.clean_body,
}
SCORED = ("bill_id", "title", "session", "sponsors")  # fields that the confidence depends on
VERSIONS: dict[str, dict[str, Extractor]] = {
    "standard": {},
    "direct_only": {"bill_id": lambda t: extract.bill_id(t, fallback=False), "session": lambda t: extract.session(t, fallback=False)},
    "uncleaned": {"body_text": lambda t: t},
    "long_titles": {"title": extract.long_title},
}


def register_version(name: str, **extractors: Extractor) -> None:
    """Add a named set of extractors (column functions, never code from files)."""
    unknown = set(extractors) - set(STANDARD)
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    VERSIONS[name] = extractors


def bill_documents(raw: DataFrame, text: str = "raw_text", version: str = "standard", fields: tuple[str, ...] | None = None) -> DataFrame:
    """`raw` with the columns of a bill document, or with those of `fields` alone.

    The fields of a text come out of one generator, `inline` of an array with one struct.  The
    optimizer moves no filter below it and puts no field's expression in the place of its name
    above it, so each extractor stands once in the plan, whatever uses its field.
    """
    rules = STANDARD | VERSIONS[version]
    scored = fields is None or "extraction_confidence" in fields
    wanted = [k for k in rules if fields is None or k in fields or scored and k in SCORED]
    bill = cleaning.without_preamble(F.col(text))
    found = let(bill, lambda t: F.struct(*[rules[k](t).alias(k) for k in wanted]))
    d = raw.select("*", F.inline(F.array(found)))
    if scored:
        d = d.withColumn("extraction_confidence", extract.checked_confidence(extract.confidence(*map(F.col, SCORED))))
    return d.drop(*[k for k in wanted if fields is not None and k not in fields])


def bill_versions(raw: DataFrame, *versions: str, text: str = "raw_text") -> DataFrame:
    """`raw` with a struct column of the document's fields for each version, from one pass: an
    extractor that versions share stands once in the plan."""
    rules = {v: STANDARD | VERSIONS[v] for v in versions}
    slots: dict[tuple[str, Extractor], str] = {}
    for r in rules.values():
        for field, extractor in r.items():
            slots.setdefault((field, extractor), f"_{field}_{len(slots)}")
    bill = cleaning.without_preamble(F.col(text))
    found = let(bill, lambda t: F.struct(*[f(t).alias(slot) for (_, f), slot in slots.items()]))
    d = raw.select("*", F.inline(F.array(found)))

    def document(v: str) -> Column:
        own = {field: F.col(slots[field, f]) for field, f in rules[v].items()}
        sure = extract.checked_confidence(extract.confidence(*[own[k] for k in SCORED]))
        return F.struct(*[c.alias(k) for k, c in own.items()], sure.alias("extraction_confidence")).alias(v)

    return d.select(*raw.columns, *map(document, versions))


def register_views(spark: SparkSession, raw: DataFrame, prefix: str = "bills_", text: str = "raw_text") -> list[str]:
    """A temporary view <prefix><version> of `raw`'s documents for each registered version, so
    that SQL names a version; a query that needs few fields still evaluates all of the view's."""
    names = [f"{prefix}{v}" for v in VERSIONS]
    for v, name in zip(VERSIONS, names, strict=True):
        bill_documents(raw, text, v).createOrReplaceTempView(name)
    return names


def only_documents(docs: DataFrame, *keys: str) -> DataFrame:
    return docs.select(*keys, *BILL_DOCUMENT.fieldNames())


def bill_records(docs: DataFrame, base_url: str, filename: str = "filename", scraped_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records in the order of the published schema, from documents and their file names.

    scraped_at: one time for the run, as ISO text in UTC; null if none is given, so that a
    rerun gives the same rows.  `keep` names further columns of `docs` to carry along.
    """
    parts = filenames.parsed(F.col(filename))
    parts |= {
        "text": F.col("body_text"),
        "source_url": filenames.source_url(base_url, F.col(filename)),
        "source_filename": F.col(filename),
        "scraped_at": scraped_at if scraped_at is not None else F.lit(None).cast("string"),
    }
    return docs.where(filenames.is_valid(F.col(filename))).select(*[parts.get(n, F.col(n)).cast(t).alias(n) for n, t in ((f.name, f.dataType) for f in BILL_RECORD)], *keep)


def quarantined(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that decoded, and those with an error; a bad item never fails the job."""
    return decoded.where("error IS NULL"), decoded.where("error IS NOT NULL")
