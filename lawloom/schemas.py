"""Schemas of the tables, and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _A = T.StringType(), T.ArrayType(T.StringType())

BILL_DOCUMENT = T.StructType(
    [
        T.StructField("bill_id", _S),
        T.StructField("title", _S),
        T.StructField("session", _S),
        T.StructField("body_text", _S),
        T.StructField("extraction_confidence", T.DoubleType()),
        T.StructField("sponsors", _A),
        T.StructField("introduced_date", T.DateType()),
        T.StructField("committee", _S),
        T.StructField("amended_code_refs", _A),
    ]
)

BILL_RECORD = T.StructType(
    [
        T.StructField("session", T.IntegerType()),
        T.StructField("ld_number", _S),
        T.StructField("document_type", _S),
        T.StructField("amendment_code", _S),
        T.StructField("amendment_type", _S),
        T.StructField("chamber", _S),
        T.StructField("text", _S),
        T.StructField("extraction_confidence", T.DoubleType()),
        T.StructField("title", _S),
        T.StructField("sponsors", _A),
        T.StructField("committee", _S),
        T.StructField("amended_code_refs", _A),
        T.StructField("source_url", _S),
        T.StructField("source_filename", _S),
        T.StructField("scraped_at", _S),
    ]
)

TEST_RESULT = T.StructType(
    [
        T.StructField("iteration", T.IntegerType()),
        T.StructField("bill_id", _S),
        T.StructField("accepted", T.BooleanType()),
        T.StructField("reasoning", _S),
        T.StructField("metadata_delta", T.DoubleType()),
        T.StructField("cleanliness_delta", T.DoubleType()),
        T.StructField("confidence_delta", T.DoubleType()),
    ]
)

# Types of documents, amendments and chambers as written in file names.
DOCUMENT_TYPES = {"LD": "bill", "SP": "sp_bill", "HP": "hp_bill", "HO": "ho_bill"}
AMENDMENT_TYPES = {"CA": "Committee Amendment", "HA": "House Amendment", "SA": "Senate Amendment"}
CHAMBERS = {"H": "House", "S": "Senate"}
