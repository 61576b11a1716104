"""Quality classifier: supervised subword embeddings (see ``subword``), case kept, over whole texts.

Defined results: a null or empty text gets the prior of the labels; without labels of both classes every text gets it; a
score equal to the threshold is good; rows that repeat are scored alike, each by its own text; very long texts are scored
whole, in pieces that share no feature less; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressmill.llm import subword
from pressmill.llm.common import free_name, table

SETTINGS = subword.Settings()
THRESHOLD = 0.3


def quality_scores(docs: DataFrame, labels: DataFrame, settings: subword.Settings = SETTINGS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better) and predicted of every document."""
    return subword.judged(subword.score(docs, subword.train(docs, labels, "quality", settings)), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, settings: subword.Settings = SETTINGS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows and columns of documents that are not rejected."""
    name = free_name(docs, "score")
    model = subword.train(docs, labels, "quality", settings)
    return subword.scored(docs, model, name).where(f"`{name}` >= {threshold}").drop(name)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
