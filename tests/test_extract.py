import datetime

import pytest
from pyspark.sql import functions as F

from lawloom.functions import cleaning, extract


def one(spark, f, text):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("x")).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("see 131-LD-0001 here", "131-LD-0001"),
        ("131st MAINE LEGISLATURE\nLegislative Document\nNo. 765", "131-LD-0765"),
        ("131ST LEGISLATURE No. 765", None),
        ("nothing", None),
    ],
)
def test_bill_id(spark, text, want):
    assert one(spark, extract.bill_id, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("x\n  An Act Relating to Education and Training \ny", "An Act Relating to Education and Training"),
        ('COMMITTEE AMENDMENT "A" to H.P. 970, L.D. 1515, "An Act to Fund Emergency Services"', "An Act to Fund Emergency Services"),
        ("Resolve, Directing\nmore", "Resolve, Directing"),
        ("none", None),
    ],
)
def test_title(spark, text, want):
    assert one(spark, extract.title, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("House of Representatives, March 15, 2024", datetime.date(2024, 3, 15)),
        ("In Senate, January 26, 2023", datetime.date(2023, 1, 26)),
        ("February 10, 2025", datetime.date(2025, 2, 10)),
        ("x" * 801 + " February 10, 2025", None),
        ("House of Representatives, June 31, 2023 In House, Jul 4, 2022", datetime.date(2022, 7, 4)),
        ("In Senate, May 3, 0000", None),
        (None, None),
    ],
)
def test_date(spark, text, want):
    assert one(spark, extract.introduced_date, text) == want


def test_committee(spark):
    assert one(spark, extract.committee, "Reference to the Committee on Judiciary suggested and ordered") == "Judiciary"
    assert one(spark, extract.committee, "Reference to the Committee on Labor.") == "Labor"
    long = "Referred to Committee on Education and Cultural Affairs\nAn Act Relating to Education"
    assert one(spark, extract.committee, long) == "Committee on Education and Cultural Affairs An Act Relating to Education"
    assert one(spark, extract.committee, "no panel") is None


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Introduced by Representative SMITH\nCosponsored by Senator JONES", ["SMITH", "JONES"]),
        ("Presented by Representative SMITH of Cumberland\nCosponsored by Senator JONES of York and Representative BROWN of Penobscot", ["SMITH", "JONES", "BROWN"]),
        ("Presented by Representative SMITH of Bath\nCosponsored by Senator JONES of York, the Town of Cumberland, Representative BROWN of Penobscot", ["SMITH", "JONES", "BROWN"]),
        ("Presented by Representative President JACKSON of Aroostook", []),
        ("Presented by President JACKSON of Aroostook", ["JACKSON"]),
        ("Presented by Senator BEEBE- CENTER of York", ["BEEBE-CENTER"]),
        ("Presented by Senator O'BRIEN of York", ["O'BRIEN"]),
        ("Presented by Senator VAN BUREN of York", ["VAN BUREN"]),
        ("Cosponsored by Representatives: MASON of Lisbon, Representative: SAYRE", []),
        ("", []),
    ],
)
def test_sponsors(spark, text, want):
    assert one(spark, extract.sponsors, text) == want


def test_code_refs(spark):
    text = "Title 20, Section 1 and Title 5, Section 10; 12 MRSA §13106-A; Title 20, § 1; Title 5, section 9"
    assert one(spark, extract.code_refs, text) == ["Title 20, Section 1", "Title 5, Section 10", "12 MRSA §13106-A"]


def test_confidence(spark):
    row = lambda i, t, s, p: spark.sql("select 1").select(extract.confidence(F.lit(i), F.lit(t), F.lit(s), F.array(*map(F.lit, p)))).first()[0]
    assert row(None, None, None, []) == 0.5
    assert row("a", None, None, []) == 0.7
    assert row(None, "t", None, []) == 0.6
    assert row("a", "t", "s", ["x"]) == 0.9999999999999999
    assert row("", "", "", []) == 0.5


def test_preamble(spark):
    assert one(spark, cleaning.without_preamble, "a\nb\n131st MAINE LEGISLATURE\nc") == "131st MAINE LEGISLATURE\nc"
    assert one(spark, cleaning.without_preamble, "a\n7 131ST LEGISLATURE\nc") == "7 131ST LEGISLATURE\nc"
    assert one(spark, cleaning.without_preamble, "a\nb") == "a\nb"


@pytest.mark.parametrize(("line", "want"), [("    1", True), ("42", True), ("123", True), ("1515", False), ("1 STATE OF MAINE", False)])
def test_line_numbers(spark, line, want):
    assert one(spark, cleaning.is_line_number, line) is want


@pytest.mark.parametrize(("line", "want"), [("Page 42 of 100", True), ("131-LD-0001", True), ("131ST LEGISLATURE", True), ("SECOND REGULAR SESSION", True), ("Some bill text", False)])
def test_headers(spark, line, want):
    assert one(spark, cleaning.is_header, line) is want


def test_body(spark):
    assert one(spark, cleaning.clean_body, "5 STATE OF MAINE\n9 COMMITTEE AMENDMENT to H.P. 970") == "COMMITTEE AMENDMENT to H.P. 970"
    assert one(spark, cleaning.clean_body, "12 MRSA §13106-A is") == "MRSA §13106-A is"
    assert one(spark, cleaning.clean_body, "\n  \n42\n") == ""


def test_long_title(spark):
    text = "An Act to Prohibit Operation of a Snowmobile\n3\nin an Area\n\nReference to the Committee"
    assert one(spark, extract.long_title, text) == "An Act to Prohibit Operation of a Snowmobile in an Area"
