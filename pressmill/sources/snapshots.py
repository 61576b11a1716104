"""Tables as numbered snapshots: a new one is written beside the old, which stays as backup; the newest complete one counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place, jvm


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete snapshots, in order."""
    fs, place, jvm = _files(spark, path)
    if not fs.exists(place):
        return []
    found = [s.getPath() for s in fs.listStatus(place)]
    return sorted(int(p.getName()[1:]) for p in found if p.getName()[:1] == "v" and p.getName()[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def write_version(df: DataFrame, path: str, number: int | None = None) -> int:
    """Write ``df`` as the next snapshot (or the given one, again if it was left unfinished) and return its number."""
    if number is None:
        number = max(versions(df.sparkSession, path), default=0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v{number}")
    return number


def current(spark: SparkSession, path: str) -> DataFrame | None:
    known = versions(spark, path)
    return spark.read.parquet(f"{path}/v{known[-1]}") if known else None
