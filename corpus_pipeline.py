"""Corpus pipeline: toxicity, exact copies, near copies, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and is written
as Parquet and read again. All but the last return the columns of ``documents``; the last adds
``copy``, the number of the emitted copy.

Defined cases, for every stage: whole texts are read, however long; a null text counts as empty; an
empty table gives an empty table; the columns of the input are carried under any name. Rows with a
null doc_id are kept by the stages that drop by id. An empty text is never toxic by its terms (its
score is the model's bias), is an exact copy of every other empty one, links with nothing, holds no
benchmark item, and is emitted by the rate of its source. Of equal texts the row of the largest doc_id
stays, one of them where ids tie; of near copies the smallest; repeated rows are copies like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depthgrid.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from depthgrid.llm.queries import table
from depthgrid.llm.shared import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted machine rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that reach each other the one with the smallest doc_id stays."""
    return near_dedup.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 75 per cent or more of a benchmark item's shingles go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that their sources come near their target sizes."""
    return mixing.emit_mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_copies", drop_exact_copies),
    ("near_copies", drop_near_copies),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
]

#: The first stage is a fitted model, which SQL cannot express; tests compare the stages with
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs)
    return docs
