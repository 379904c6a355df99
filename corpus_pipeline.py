"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, lines, packing, simhash, toxicity
from larder.llm.queries import table, token_file
from larder.llm.shared import Stored


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The model learns from the labels of these documents."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them. No document goes."""
    return lines.without_shared_lines(docs)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of op1 stays: texts whose fingerprints link."""
    return simhash.without_near_duplicates(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.packed(docs, token_file())


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", lines_once),
    ("near_dedup", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("packing", pack),
]

#: SQL cannot express the trained model, the similarity classes and the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; every stage's result is a stored table."""
    stored = Stored(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        docs = found if name == STAGES[-1][0] else stored.write(found)
    return docs
