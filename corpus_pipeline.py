"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.  Null texts count as empty, very long ones
are read whole, rows that repeat are documents of their own until the exact
deduplication, further columns are handed on up to the packing, and an empty
table stays empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateweave.llm.common import noting, written
from rateweave.llm.exact import drop_exact_duplicates
from rateweave.llm.mixing import resample
from rateweave.llm.packing import pack_documents
from rateweave.llm.quality import drop_low_quality
from rateweave.llm.simhash import drop_near_duplicates
from rateweave.sources.versioned import release
from rateweave.sources.views import read_table

def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject."""
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the largest id."""
    return drop_exact_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id."""
    return drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all or up to three times."""
    return resample(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 1024 tokens."""
    return pack_documents(docs)


STAGES = [(f.__name__, f) for f in (
    quality_classifier, exact_dedup, simhash_near_dedup, source_mixing, best_fit_packing)]

# SQL cannot express the classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``.

    Some stages number their rows in a copy of the table that they are given.
    A copy is freed here, once the result that was made from it is written; a
    stage that is called by itself frees nothing, so that earlier results and
    a second call stay good.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        copies: list[DataFrame] = []
        with noting(copies):
            docs = written(function(spark, docs, sf_dir), name)
        for copy in copies:
            release(copy)
    return STAGES[-1][1](spark, docs, sf_dir)
