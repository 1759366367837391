"""Metadata of a bill from its text, as chains of fallbacks that `coalesce` evaluates lazily."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import all_found, found, let, lines, normalised, strip, u, window


def bill_id(text: Column, fallback: bool = True) -> Column:
    direct = found(text, P.BILL_ID, 0)
    if not fallback:
        return direct
    # these patterns take any white space, so the text needn't be normalised
    number = F.coalesce(found(text, P.DOCUMENT_NUMBER), found(text, P.BARE_NUMBER))
    return F.coalesce(direct, F.concat(found(text, P.SESSION_ORDINAL), F.lit("-LD-"), F.lpad(number, 4, "0")))


def title(text: Column) -> Column:
    """From "An Act", else "Resolve", to the end of the first line that holds either."""

    def cut(line: Column) -> Column:
        tail = strip(F.substr(line, F.when(line.contains("An Act"), F.instr(line, "An Act")).otherwise(F.instr(line, "Resolve"))))
        return F.regexp_replace(F.regexp_replace(tail, '^"+|"+$', ""), "^'+|'+$", "")

    return let(found(text, r"(?m)^[^\n]*?(?:An Act|Resolve)[^\n]*", 0), cut)


def session(text: Column, fallback: bool = True) -> Column:
    direct = found(text, P.SESSION_ID)
    if not fallback:
        return direct
    head = window(text, 2000)
    return F.coalesce(direct, found(head, P.SESSION_ORDINAL), found(head, P.SESSION_STATE))


def _date(x: Column, pattern: str) -> Column:
    """The date of the first match; null if there is none or it isn't in the calendar."""
    parts = F.regexp_replace(found(x, pattern, 0), u(f"(?s)^.*?{P.DATE}$"), "$3 $1 $2")
    return let(F.split(parts, " "), lambda p: F.when(p[0] != "0000", F.try_to_date(F.concat_ws(" ", p[0], F.substring(p[1], 1, 3), p[2]), "yyyy MMM d")))


def introduced_date(text: Column) -> Column:
    near = _date(normalised(window(text, 800)), P.DATE)
    return F.coalesce(let(normalised(window(text, 2500)), lambda head: F.coalesce(_date(head, P.DATE_IN_HOUSE), _date(head, P.DATE_IN_SENATE))), near)


def committee(text: Column) -> Column:
    some = lambda x: F.get(F.filter(F.array(x), lambda v: v != ""), F.lit(0))

    def first(head: Column) -> Column:
        stopped = F.regexp_replace(strip(found(head, P.COMMITTEE_STOP)), u(P.COMMITTEE_TAIL, "i"), "")
        return F.coalesce(some(strip(found(head, P.COMMITTEE_ACTION))), some(stopped), some(strip(found(head, P.COMMITTEE_OTHER))))

    return let(normalised(window(text, 2500)), first)


def repair_hyphens(x: Column) -> Column:
    """BEEBE- CENTER as BEEBE-CENTER."""
    return F.regexp_replace(x, u(P.LOOSE_HYPHEN), "$1-$2")


def is_name(name: Column) -> Column:
    """At most two words, none of them a title, office or place."""
    words = F.split(name, r"\s+")
    return (name != "") & (F.size(words) <= 2) & ~F.arrays_overlap(words, F.array(*map(F.lit, P.NOT_NAMES)))


def sponsors(text: Column) -> Column:
    # the end of a match is looked at, not taken, so that the next one may begin there
    alone = P.PRESENTED_ALONE.replace("(?:\\s+(?:Cosponsored", "(?=\\s+(?:Cosponsored")

    def named(head: Column) -> Column:
        block = normalised(F.coalesce(found(head, P.COSPONSORS), F.lit("")))
        others = let(block, lambda b: F.concat(all_found(b, P.COSPONSOR_OF), all_found(b, P.COSPONSOR_ALONE)))
        return F.concat(all_found(head, P.PRESENTED_OF), all_found(head, alone), others)

    names = let(repair_hyphens(normalised(window(text, 2500))), named)
    tidy = F.transform(F.filter(F.transform(names, strip), is_name), lambda x: strip(F.regexp_replace(x, u(r"\s*-\s*"), "-")))
    return F.array_distinct(tidy)


def code_refs(text: Column) -> Column:
    """References to titles and sections, in both forms, in order and without repeats."""
    titles = F.transform(all_found(text, P.TITLE_REF, 0), lambda m: F.regexp_replace(m, u(P.TITLE_REF), "Title $1, Section $2"))
    mrsa = F.transform(all_found(text, P.MRSA_REF, 0), lambda m: F.regexp_replace(m, u(P.MRSA_REF), "$1 MRSA §$2"))
    return F.array_distinct(F.concat(titles, mrsa))


def confidence(bill: Column, name: Column, sess: Column, people: Column) -> Column:
    """0.5 for text, and more for what was found; added in this order, as doubles."""
    some = lambda x: x.isNotNull() & (x != "")
    out = F.lit(0.5)
    for test, weight in ((some(bill), 0.2), (some(name), 0.1), (some(sess), 0.1), (F.size(people) > 0, 0.1)):
        out = out + F.when(F.coalesce(test, F.lit(False)), F.lit(weight)).otherwise(F.lit(0.0))
    return out


def checked_confidence(x: Column) -> Column:
    return F.when(x.between(0.0, 1.0), x).otherwise(F.raise_error(F.concat(F.lit("extraction_confidence must be between 0.0 and 1.0, got "), x.cast("string"))).cast("double"))


# ---- extensions: described for the corpus but not part of the standard extraction


def is_citizen_initiative(text: Column) -> Column:
    return normalised(window(text, 2000)).rlike(u(P.INITIATIVE, "i"))


def long_title(text: Column) -> Column:
    """The title with the lines that continue it: those that begin with a small letter, a
    bracket or a dash, up to a blank line or the words that follow titles."""
    ls = F.filter(F.transform(lines(text), strip), lambda x: ~x.rlike(r"^\d+$"))
    at = F.array_position(F.transform(ls, lambda x: x.contains("An Act") | x.contains("Resolve")), F.lit(True)).cast("int")
    rest = F.slice(ls, F.greatest(at, F.lit(0)) + 1, F.size(ls))
    goes_on = lambda x: x.rlike("^[a-z(–-]") & ~x.rlike("^(Reference to|Presented by|Cosponsored)")
    start = F.struct(F.lit(True).alias("on"), F.array().cast("array<string>").alias("parts"))
    step = lambda s, x: F.when(s["on"] & goes_on(x), F.struct(F.lit(True).alias("on"), F.concat(s["parts"], F.array(x)).alias("parts"))).otherwise(F.struct(F.lit(False).alias("on"), s["parts"].alias("parts")))
    more = F.aggregate(rest, start, step, lambda s: s["parts"])
    return F.when(at > 0, F.array_join(F.concat(F.array(title(text)), more), " "))


def early_confidence(text: Column, name: Column) -> Column:
    """The former rule: length and key words, at most one."""
    words = sum((F.when(text.contains(w), 0.05).otherwise(0.0) for w in ("AMENDMENT", "SECTION", "enacted")), F.lit(0.0))
    return F.least(F.lit(1.0), F.least(F.lit(1.0), F.length(text) / F.lit(5000.0)) + words + F.when(name.isNotNull(), 0.05).otherwise(0.0))
