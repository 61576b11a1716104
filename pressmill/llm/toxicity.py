"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly (see ``subword``), case folded, so
that a misspelling never seen shares the vectors of its character n-grams with the word it comes from.

Defined results: a null or empty text gets the prior of the labels; without labels of both classes every text gets it; a
score equal to the threshold is toxic; rows that repeat are scored alike; very long texts are scored whole; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressmill.llm import subword
from pressmill.llm.common import table

SETTINGS = subword.Settings(lowercase=True)
THRESHOLD = 0.5


def toxicity_scores(docs: DataFrame, labels: DataFrame, settings: subword.Settings = SETTINGS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: likelier toxic) and predicted of every document."""
    return subword.judged(subword.score(docs, subword.train(docs, labels, "toxic", settings)), threshold)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
