"""Scans in a total order, such as what stands before and after a row, or running counts, without one task for all rows.

Rows are dealt into ranges of the order by sampled quantiles and written once, sorted, with the number of their range; a
window then runs within a range. What a range hands to the next, its last row or its count, is a table of one row a range,
and only that is scanned in one piece and broadcast: as many rows as there are ranges, whatever the data. Since the whole
key is cut, a day or a publication that holds most rows is in many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.sources.store import shared_place

KEY, RANGE = "_key", "_range"


def in_ranges(rows: DataFrame, key: Column, parts: int | None = None) -> DataFrame:
    """``rows`` with their key and range, from a table written in order. Keys should differ between rows."""
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_place(spark, "ordered")
    ranged = rows.withColumn(KEY, key).repartitionByRange(parts, KEY).sortWithinPartitions(KEY).withColumn(RANGE, F.spark_partition_id())
    ranged.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def _handed(ranged: DataFrame, per_range: DataFrame) -> DataFrame:
    return ranged.join(F.broadcast(per_range), RANGE)  # a row for each range


def with_neighbours(ranged: DataFrame, value: Column, before: str | None = None, after: str | None = None) -> DataFrame:
    """``value`` of the row before and of the row after each in the order, null at the ends."""
    inside, across = Window.partitionBy(RANGE).orderBy(KEY), Window.orderBy(RANGE)
    rows = ranged.withColumn("_value", value)
    ends = rows.groupBy(RANGE).agg(F.min_by("_value", KEY).alias("_first"), F.max_by("_value", KEY).alias("_last"))
    ends = ends.select(RANGE, F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after"))
    rows = _handed(rows, ends)
    if before:
        rows = rows.withColumn(before, F.coalesce(F.lag("_value").over(inside), "_before"))
    if after:
        rows = rows.withColumn(after, F.coalesce(F.lead("_value").over(inside), "_after"))
    return rows.drop("_value", "_before", "_after")


def with_running_sum(ranged: DataFrame, value: Column, name: str) -> DataFrame:
    """The sum of ``value`` over all rows up to each."""
    inside, across = Window.partitionBy(RANGE).orderBy(KEY), Window.orderBy(RANGE)
    rows = ranged.withColumn("_value", value)
    sums = rows.groupBy(RANGE).agg(F.sum("_value").alias("_sum"))
    sums = sums.select(RANGE, (F.sum("_sum").over(across) - F.col("_sum")).alias("_earlier"))
    rows = _handed(rows, sums).withColumn(name, F.col("_earlier") + F.sum("_value").over(inside))
    return rows.drop("_value", "_earlier")


def without_order(rows: DataFrame) -> DataFrame:
    return rows.drop(KEY, RANGE)
