import random

import pytest
from pyspark.sql import functions as F

from lawloom.functions import scores
from lawloom.operators import quality, rosters
from lawloom.operators.documents import bill_documents, bill_versions, register_views
from lawloom.plans.bills_view import bills
from lawloom.plans.catalogue import QUERIES
from lawloom.reports import comparison_reports, field_changes, score_changes, summary_report


@pytest.mark.parametrize(
    ("deltas", "accepted", "reason"),
    [
        ((-1, 50.0, 0.5), False, "Metadata regression: lost extracted fields"),
        ((0, -5.5, 0.0), False, "Text cleanliness regression: -5.5"),
        ((2, 6.0, 0.1), True, "+2 metadata fields, +6.0 cleanliness, +0.10 confidence"),
        ((0, 5.0, 0.05), False, "No measurable improvement"),
        ((0, -5.0, 0.2), True, "+0.20 confidence"),
    ],
)
def test_verdicts(spark, deltas, accepted, reason):
    c = [F.lit(x) for x in deltas]
    assert tuple(spark.range(1).select(scores.accepted(*c), scores.reasoning(*c)).first()) == (accepted, reason)


def test_cleanliness(spark):
    text = "  42  \nSTATE OF MAINE\nPage 5\nReproduced from\nLAW AND LEGISLATIVE\nfine"
    assert spark.range(1).select(scores.cleanliness(F.lit(text))).first()[0] == 100 - 0.5 - 2 - 1 - 4
    assert spark.range(1).select(scores.cleanliness(F.lit("12\rabc\x85\u20287"))).first()[0] == 100.0  # only \n ends a line
    assert spark.range(1).select(scores.cleanliness(F.lit("MAINE LEGISLATURE " * 80))).first()[0] == 0.0


def _docs(spark):
    rows = [("a", "131", "An Act", ["X"], "Labor", ["r"], 1.0, None), (None, None, "Unknown Title", [], None, [], 0.5, None), (None, None, None, None, None, None, None, "failed")]
    return spark.createDataFrame(rows, "bill_id string, session string, title string, sponsors array<string>, committee string, amended_code_refs array<string>, extraction_confidence double, error string")


def test_rates_and_gate(spark):
    r = quality.quality_rates(_docs(spark)).first()
    assert (r["total_bills"], r["successful_extractions"]) == (3, 2)
    assert [r[c] for c in ("bill_id_rate", "session_rate", "title_rate", "sponsor_rate", "committee_rate", "code_ref_rate")] == [0.5] * 6
    assert (r["avg_sponsors"], r["avg_confidence"]) == (0.5, 0.75)
    assert quality.gated(quality.quality_rates(_docs(spark))).first()["gate_passed"] is False


def test_roster(spark):
    df = spark.createDataFrame([(1, ["SMITH", "Town", "University"]), (2, ["Smith", "TALBOT-ROSS"]), (3, []), (4, None)], "id int, sponsors array<string>")
    known = spark.createDataFrame([("SMITH",), ("TALBOT-ROSS",)], "last_name string")
    want = {1: ["SMITH"], 2: ["Smith", "TALBOT-ROSS"], 3: [], 4: None}
    assert dict(map(tuple, rosters.validate_sponsors(df, known).collect())) == want
    assert rosters.validate_sponsors(df, None).collect() == df.collect()
    assert all(r[1] == [] for r in rosters.validate_sponsors(df.where("id < 4"), known.limit(0)).collect())
    small, rosters.SMALL = rosters.SMALL, 1
    try:
        twice = df.union(df)
        got = [tuple(r) for r in rosters.validate_sponsors(twice, known).collect()]
        assert sorted(got, key=str) == sorted([*want.items(), *want.items()], key=str)
    finally:
        rosters.SMALL = small


def test_links(spark):
    s = spark.createDataFrame([("SMITH",), ("BROWN",), ("JOHNSON",), ("OBRIEN",), ("QQQQQ",)], "sponsor string")
    r = spark.createDataFrame([(1, "Smith"), (2, "Brown"), (3, "Brown"), (4, "Johnsen"), (5, "O'Brian")], "legislator_id long, last_name string")
    exact = {x["sponsor"]: (x["n_matches"], x["ambiguous"]) for x in rosters.link_exactly(s, r).collect()}
    assert exact == {"SMITH": (1, False), "BROWN": (2, True), "JOHNSON": (0, False), "OBRIEN": (0, False), "QQQQQ": (0, False)}
    assert {(x[0], x[1], x[2]) for x in rosters.link_nearly(s, r).collect()} == {("JOHNSON", 4, 1), ("OBRIEN", 5, 1)}


def test_summary(spark):
    rows = [(1, True, 2.0, 10.0, 0.1), (2, True, 3.0, 0.0, 0.2), (3, False, -1.0, None, None)]
    df = spark.createDataFrame(rows, "iteration int, accepted boolean, metadata_delta double, cleanliness_delta double, confidence_delta double")
    assert quality.best_iteration(df, "iteration").first()["iteration"] == 1
    s = quality.accept_summary(df).first()
    assert (s["total"], s["n_accepted"]) == (3, 2) and abs(s["success_rate"] - 200 / 3) < 1e-9
    assert quality.accept_summary(df.limit(0)).first()["success_rate"] == 0.0
    text = summary_report(df)
    assert "| accepted | 2 of 3 (67 %) |" in text and "| mean metadata delta | +1.33 |" in text and "| best iteration | 1 (3.00) |" in text
    with pytest.raises(ValueError, match="no iterations"):
        summary_report(df.limit(0))


def test_changes(spark):
    schema = "id int, bill_id string, sponsors array<string>"
    a = spark.createDataFrame([(1, None, ["X"])], schema)
    b = spark.createDataFrame([(1, "131-LD-0001", ["X"])], schema)
    rows = field_changes(a, b, "id", ("bill_id", "sponsors"))
    assert {(r["field"], r["status"]) for r in rows.collect()} == {("bill_id", "✅"), ("sponsors", "—")}


def test_comparison_reports(spark):
    """Fields, scores and verdict of each document; what falls below its gate is marked."""
    old = spark.createDataFrame([(1, None, 3, 90.0, 0.7), (2, "131-LD-0002", 5, 99.0, 0.9)], "id int, bill_id string, metadata_score int, cleanliness_score double, extraction_confidence double")
    new = spark.createDataFrame([(1, "131-LD-0001", 5, 97.5, 0.9), (2, None, 4, 50.0, 0.7)], old.schema)
    changes = score_changes(old, new, "id")
    assert {(r["id"], r["measure"]) for r in changes.where("NOT kept").collect()} == {(2, "metadata_score"), (2, "cleanliness_score")}
    verdicts = quality.compared(old, new, "id")
    text = {r["id"]: r["markdown"] for r in comparison_reports(field_changes(old, new, "id", ("bill_id",)), changes, verdicts, "id").collect()}
    assert text[1].startswith("# 1 accepted\n\n+2 metadata fields, +7.5 cleanliness, +0.20 confidence\n\n| measure |")
    assert "| metadata_score | 3 → 5 (+2) |  |" in text[1] and "| bill_id |  | 131-LD-0001 | ✅ |" in text[1]
    assert text[2].startswith("# 2 rejected") and "| cleanliness_score | 99.0 → 50.0 (-49.0) | lost |" in text[2]


def test_versions_from_one_pass(spark, sf_dir):
    raw = bills(spark, sf_dir)
    both = bill_versions(raw, "direct_only", "uncleaned", "standard")
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Cosponsored by\\s+(") == 1
    for v in ("direct_only", "uncleaned"):
        got = both.select("doc_id", f"{v}.*")
        want = bill_documents(raw, version=v).select(*got.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_versions_have_views(spark, sf_dir):
    names = register_views(spark, bills(spark, sf_dir))
    assert "bills_long_titles" in names
    got = spark.sql("SELECT doc_id, title FROM bills_long_titles WHERE title IS NOT NULL")
    want = bill_documents(bills(spark, sf_dir), version="long_titles").where("title IS NOT NULL").select("doc_id", "title")
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0


def test_each_extractor_stands_once(spark, sf_dir):
    """Whatever uses a field, its patterns are in the plan once, so they are evaluated once."""
    for name in ("link_fuzzy", "link_exact", "quality_by_session", "bill_record", "bill_document"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Cosponsored by\\s+(") <= (2 if name == "link_fuzzy" else 1), name
        assert plan.count("Reference to the Committee on\\s+([A-Za-z\\s&,]+?)\\s") <= 1, name


def test_link_nearly_short_roster_names(spark):
    r = spark.createDataFrame([(1, "Li"), (2, "B"), (3, "Johnson")], "legislator_id int, last_name string")
    s = spark.createDataFrame([("OX",), ("XYZ",), ("LIAM",), ("WXYZQ",)], "sponsor string")
    assert {tuple(x) for x in rosters.link_nearly(s, r).collect()} == {("OX", 1, 2), ("LIAM", 1, 2)}
    assert {x[0] for x in rosters.unmatched(s, r).collect()} == {"XYZ", "WXYZQ"}


def test_near_matches_against_all_pairs(spark):
    """Every pair within two edits, however the letters differ, and how many are as near."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    known = [(k, word(rng.randint(1, 7))) for k in range(40)]
    asked = sorted({word(rng.randint(1, 8)) for _ in range(60)} | {"", "x" * 300, "-"})
    r = spark.createDataFrame(known, "legislator_id long, last_name string")
    s = spark.createDataFrame([(a,) for a in asked], "sponsor string")
    got = {x["sponsor"]: tuple(x)[1:] for x in rosters.near_matches(s, r).collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i, *[0] * len(b)], row
            for j, y in enumerate(b, 1):
                row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
        return row[-1]

    for a in asked:
        if a.isalpha() and any(a == b for _, b in known):
            assert a not in got
            continue
        near = sorted((edits(a, b), k) for k, b in known if a.isalpha() and edits(a, b) <= 2)
        same = [k for d, k in near if d == near[0][0]]
        assert got[a] == ((same[0], near[0][0], len(same), len(same) > 1) if near else (None, None, 0, False)), a
