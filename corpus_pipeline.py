"""The corpus pipeline: documents through two filters and two kinds of duplicates to packed pieces.

Each stage takes (spark, docs, sf_dir), works on every row it is given, and learns, where it learns,
only from those. A stage before the last returns rows of ``docs`` with all their columns.
"""

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapekeeper.llm import exact_dedup, langid, simhash, toxicity
from tapekeeper.llm.queries import REJECTED_SEVERITY, RADIUS, SHINGLE, language_model, packed, table, toxicity_model
from tapekeeper.llm.shared import ship, written


def stage(fn):
    """A stage that first gives the executors the package."""

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, docs, sf_dir)

    return run


@stage
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose expected severity stays below the bound; null and empty texts have no words and stay."""
    scored = toxicity.score_severity(docs, toxicity_model(spark, docs, sf_dir), keep=tuple(docs.columns))
    return scored.filter(F.col("severity") < REJECTED_SEVERITY).select("row.*")


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; texts that are null, have no letter, or resemble no known language go."""
    found = langid.predict_languages(docs, language_model(docs), keep=tuple(docs.columns))
    return found.filter("not rejected").select("row.*")


@stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest id."""
    return exact_dedup.drop_copies(docs)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest id."""
    return simhash.drop_near_copies(docs, SHINGLE, RADIUS)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest in windows of 2048 ids, a row per piece."""
    return packed(docs)


STAGES = [("toxicity", toxic), ("language", language), ("exact_dedup", exact), ("simhash_dedup", near), ("packing", pack)]

# No SQL: learned filters, XXH64 and tokenizers are beyond it; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each over what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = written(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
