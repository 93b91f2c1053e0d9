"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next.

Every stage takes the documents its predecessor kept, whole; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, near_duplicates, packing, quality, repeats
from millrace.llm.common import table, written
from millrace.session import prepare


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the classifier expects the best grade; those it rejects (toxic or poor) go."""
    prepare(spark)
    return quality.keep_accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    prepare(spark)
    return near_duplicates.drop_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 100 bytes or more that start earlier too."""
    prepare(spark)
    return repeats.remove_repeats(docs)


def without_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item."""
    prepare(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences of 4096."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality", accept),
    ("near-duplicates", one_of_each),
    ("repeats", without_repeats),
    ("decontamination", without_tests),
    ("packing", packed),
]

#: SQL can express neither the fitted classifier nor the vocabulary's tokens; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the whole ``documents`` table."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
