"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before
it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage, read_table
from loanlens.llm.decontaminate import decontaminate
from loanlens.llm.ngram_join import Measure, keep_first
from loanlens.llm.quality import keep_good
from loanlens.llm.queries import packed
from loanlens.llm.secret_scan import redact

# Five words and a similarity of 0.8.
NEAR = Measure(words=5, numerator=80, denominator=100)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near copies."""
    return keep_first(docs, measure=NEAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than one in twenty lies in benchmark passages."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences."""
    return packed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", first_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", sequences),
]

# The fitted ensemble, signatures of sets, code-point spans and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; every stage's result is written."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
