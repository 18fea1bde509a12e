"""Documents to packed batches, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's documents. All but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import fresh, table
from starload.llm.language_id import UNKNOWN, held_out, learn, predict
from starload.llm.line_dedup import drop_frequent_lines
from starload.llm.packing import pack
from starload.llm.quality_domains import BUDGET_RATIO, TARGETS, domains
from starload.llm.simhash_dedup import one_of_each_group
from starload.llm.soft_mixing import mixture
from starload.session import stored

# No SQL can parse texts against suffix automata or fit rates: tests compare with brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in some language; texts without a letter go.

    Where no document names its language there is nothing to judge by, and all stay.
    """
    samples = learn(docs.filter(~held_out()))
    if not samples:
        return docs
    names = fresh(docs, "lang_pred", "score")
    judged = predict(docs, samples, into=tuple(names))
    return judged.filter(F.col(names[0]) != UNKNOWN).drop(*names)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    counts = fresh(docs, "n_lines", "n_dropped")
    return drop_frequent_lines(docs, min_docs=10, min_chars=1, into=tuple(counts)).drop(*counts)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return one_of_each_group(docs, shingle=3, radius=3)


def weighted_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture wants them."""
    labels = domains(table(spark, sf_dir, "labels"))
    return mixture(docs, labels, TARGETS, BUDGET_RATIO)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of a document in the batches."""
    return pack(docs)


STAGES = [
    ("language", known_language),
    ("lines", own_lines),
    ("near_duplicates", distinct_texts),
    ("mixture", weighted_domains),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
