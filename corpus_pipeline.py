"""Documents to packed training sequences: quality, exact and near copies, private data, packing.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of the documents they were given;
``run`` writes what a stage returns to the shared folder and reads it again for the next; what a stage has read is deleted then.

Defined results: columns besides id and text pass through all stages but the last, whatever their names; a null text counts
as empty and is judged, kept once and packed as such; rows that repeat count as exact copies; very long texts are taken whole
by each stage; an empty table gives an empty table of packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import exact_dedup, near_dedup, packing, pii, quality
from pressmill.llm.common import discard, staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.replace_private(docs, count_col=None)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("minhash near-dedup", without_near_copies),
    ("private data", without_private_data),
    ("best-fit packing", packed),
]

#: SQL can't express the trained classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, source = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            before, docs = source, staged(docs, "stage")
            if before is not None:
                discard(before)
            source = docs
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
