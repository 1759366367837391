import pytest
from pyspark.sql import functions as F

from lawloom.functions import filenames
from lawloom.operators import selection

CASES = [
    ("131-LD-0001", (131, "0001", "bill", None, None, None)),
    ("131-SP-0042", (131, "0042", "sp_bill", None, None, None)),
    ("131-LD-0686-CA_A_H0266", (131, "0686", "bill", "CA_A_H0266", "Committee Amendment", "House")),
    ("132-LD-0004-CA_A_SA_A_S337", (132, "0004", "bill", "CA_A_SA_A_S337", "Committee Amendment", "Senate")),
    ("122-LD-0001-CA_A-HA_A_H5", (122, "0001", "bill", "CA_A-HA_A_H5", "Committee Amendment", "House")),
    ("131-HO-0021-HA_A_H21", (131, "0021", "ho_bill", "HA_A_H21", "House Amendment", "House")),
    ("131-LD-0075-SA_A_S0200", (131, "0075", "bill", "SA_A_S0200", "Senate Amendment", "Senate")),
    ("131-LD-0075-XA_A_S0200", (131, "0075", "bill", "XA_A_S0200", "XA", "Senate")),
]
BAD = ["invalid", "131-LD", "LD-0001", "131-LD-0001-INVALID", "131-XX-0001", "132-SP-0519_HA_A", ""]


def test_parts(spark):
    df = spark.createDataFrame([(c,) for c, _ in CASES], "f string")
    p = filenames.parsed(F.col("f"))
    rows = df.select("f", *[p[k].alias(k) for k in ("session", "ld_number", "document_type", "amendment_code", "amendment_type", "chamber")]).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == dict(CASES)


def test_invalid_names_are_filtered_and_counted(spark):
    df = spark.createDataFrame([(c,) for c in [*BAD, "131-LD-0001", None]], "filename string")
    assert [r[0] for r in selection.valid_filenames(df).collect()] == ["131-LD-0001"]
    assert tuple(selection.filename_counts(df).first()) == (1, len(BAD) + 1)


def test_strict_raises(spark):
    df = spark.createDataFrame([("nonsense",)], "f string")
    with pytest.raises(Exception, match="Unexpected filename format"):
        df.select(filenames.parsed(F.col("f"), strict=True)["session"]).collect()


def test_base_bills_fall_back_to_all(spark):
    df = spark.createDataFrame([("131-LD-0001-CA_A_H1",), ("bad",)], "filename string")
    assert selection.base_bills(df).count() == 1
    df = spark.createDataFrame([("131-LD-0001-CA_A_H1",), ("131-LD-0002",)], "filename string")
    assert [r[0] for r in selection.base_bills(df).collect()] == ["131-LD-0002"]


def test_increment_and_sample(spark):
    df = spark.createDataFrame([(i, f"131-LD-{i:04d}") for i in range(200)], "id int, filename string")
    done = df.where("id < 150").select("filename")
    assert selection.not_yet(df, done, "filename").count() == 50
    s = selection.sample(df, 7, "id")
    assert s.count() == 7 and s.agg(F.max("id")).first()[0] < 100
    assert s.collect() == selection.sample(df, 7, "id").collect()
