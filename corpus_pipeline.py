"""A corpus pipeline over `documents`: each stage works on all that the one before kept.

1. language  - documents without a recognisable language go (error-correcting output codes)
2. lines     - lines found in three documents or more stay in the last one only
3. near      - of each group of near-duplicate documents the one of the least doc_id stays
4. mixing    - documents are sampled so that sources, languages and topics meet their shares
5. pieces    - the texts become SentencePiece ids

All but the last stage return the columns of `documents`; n_chars follows the text.

Defined results: rows without a doc_id go in the first stage, and so do null and empty texts
and those without a letter, of which no language is known; an empty table gives an empty one.
Repeated rows and equal doc_ids stay as long as their texts do: line dedup keeps a line in
every row of the largest doc_id that holds it, and of near-duplicate documents each row of the
least doc_id stays.  Ties have fixed winners (the first language by name, the largest doc_id
of a line, the least of a group, the leftmost merge).  Very long texts are read whole in every
stage.  Columns other than those of `documents` are dropped, so none can clash; a null source
or language is a value of its own when mixing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm import langid, lines, mixing, ngram_join, pieces
from lawloom.llm.common import discard, materialised, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.identified(docs.select(*COLUMNS), model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    first = ngram_join.jaccard_components(docs, width=5, percent=80).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first.hint("shuffle_hash"), "doc_id", "left_semi").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    even = {"source": 0.9, "lang": 0.9, "topic": 0.9}
    return mixing.mix_to_targets(docs, alphas=even, keep=0.8).where("sampled").select(*COLUMNS)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("sentence_pieces", sentence_pieces),
]

ORACLE_SQL: str | None = None  # learned, iterative and sampled stages have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written once to the shared folder, so
    that no stage is computed again for the next ones, and deleted when the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialised(docs)
            if k:
                discard(before)
    return docs
