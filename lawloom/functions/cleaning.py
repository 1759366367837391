"""Boilerplate: preamble, line numbers, headers and footers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import HEADER, HEADER_ID, LINE_NUMBER, MARGIN_NUMBER, NUMBER_PREFIX, ORDINAL_LINE
from .text import BLANKS, found, in_line, strip, u


def without_preamble(text: Column) -> Column:
    """From the first line that names the legislature, with or without a number in its margin;
    all of the text if none does."""
    return F.coalesce(found(text, f"(?ims)^(?:{BLANKS}*|{in_line(MARGIN_NUMBER)}){in_line(ORDINAL_LINE)}.*", 0), text)


def is_line_number(line: Column) -> Column:
    return line.rlike(u(LINE_NUMBER))


def is_header(line: Column) -> Column:
    s = strip(line)
    return s.rlike(u(HEADER, "i")) | s.rlike(u(HEADER_ID))


def clean_body(text: Column) -> Column:
    """Lines without numbers, margins, headers and blank lines: three passes over the text, as
    the margin goes after the lines of numbers alone and before headers are looked for."""
    end = r"(?:\n|\z)"
    kept = F.regexp_replace(text, u(f"^{in_line(LINE_NUMBER).removesuffix('$')}{end}", "m"), "")
    bare = F.regexp_replace(kept, u(f"^{in_line(NUMBER_PREFIX)}", "m"), "")
    header = f"(?i:{in_line(HEADER)})[^\\n]*|{in_line(HEADER_ID).removesuffix('$')}{BLANKS}*"
    return strip(F.regexp_replace(bare, u(f"^{BLANKS}*(?:{header})?{end}", "m"), ""))
