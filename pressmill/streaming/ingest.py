"""Article records that arrive as JSON lines files, upserted into a snapshot table batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressmill.operators.merge import keep_last, upsert
from pressmill.sources import snapshots
from pressmill.sources.archive import ARTICLE_RECORD

OVERWRITE = ["title", "subtitle", "authors", "tags", "body", "is_full", "raw_html_path", "scraped_at", "kind"]
FILL = ["issue_url", "published_date"]
FIXED = ["publication"]


def upsert_batch(state: str):
    """A batch becomes snapshot number batch + 1. A batch that is run again after a failure starts from the snapshot before
    it and writes the same one, so nothing counts twice."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = [v for v in snapshots.versions(spark, state) if v <= number]
        last = keep_last(batch, "url", ["scraped_at"])
        old = spark.read.parquet(f"{state}/v{done[-1]}") if done else last.limit(0).select("url", *OVERWRITE, *FILL, *FIXED)
        snapshots.write_version(upsert(old, last, "url", OVERWRITE, FILL, FIXED), state, number + 1)

    return run


def ingest(spark: SparkSession, incoming: str, state: str, checkpoint: str) -> StreamingQuery:
    """Take in all files that are there, each once, and stop."""
    records = spark.readStream.schema(ARTICLE_RECORD).option("mode", "FAILFAST").json(incoming).where(F.col("url").isNotNull())
    return records.writeStream.foreachBatch(upsert_batch(state)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
