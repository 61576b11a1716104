"""Keep-last, upserts and other state: each gives the new snapshot of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.operators.reports import is_short, long


def keep_last(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last record of each key by the order columns."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order]))
    return records.withColumn("_place", last).where("_place = 1").drop("_place")


def upsert(old: DataFrame, new: DataFrame, key: str, overwrite: list[str], fill: list[str], fixed: list[str] = ()) -> DataFrame:
    """Rows of both by key. ``overwrite`` columns take the new value, null too; ``fill`` columns only one that isn't null;
    ``fixed`` columns keep the old value once there is one row."""
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    fresh = F.col("n._new").isNotNull()
    known = F.col(f"o.{key}").isNotNull()
    columns = [F.coalesce(f"n.{key}", f"o.{key}").alias(key)]
    columns += [F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in overwrite]
    columns += [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in fill]
    columns += [F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in fixed]
    return both.select(*columns)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows stay; of new keys one row each."""
    return old.unionByName(new.join(old, keys, "left_anti").dropDuplicates(keys))


def not_loaded(wanted: DataFrame, loaded: DataFrame, key: str = "url") -> DataFrame:
    return wanted.join(loaded, key, "left_anti")


def issues_done(arts: DataFrame, least: int = 3) -> DataFrame:
    return arts.where("issue_id is not null").groupBy("issue_id").agg(long(F.count("*")).alias("n")).where(F.col("n") >= least)


def pending_issues(issues: DataFrame, arts: DataFrame) -> DataFrame:
    """Issues with a document and a partial piece never tried, newest first."""
    lacking = arts.where(~F.col("is_full") & (F.col("kind") != "portada") & F.col("pdf_rescued_at").isNull()).select("issue_id")
    return issues.where("pdf_url is not null").join(lacking, "issue_id", "left_semi").orderBy(F.desc_nulls_last("published_date"), "issue_id")


def pending_enrichment(arts: DataFrame) -> DataFrame:
    """Full pieces with a body that aren't enriched, newest first, undated ones before all."""
    rows = arts.where((F.col("kind") != "portada") & F.col("is_full") & ~F.col("enriched") & (F.coalesce("body", F.lit("")) != ""))
    return rows.orderBy(F.desc_nulls_first("published_date"), "id")


def load_summary(arts: DataFrame) -> DataFrame:
    return arts.groupBy("pub_slug").agg(long(F.count("*")).alias("n"), long(F.count_if("is_full")).alias("full"), long(F.count_if(is_short())).alias("short"), F.min("published_date").alias("first_date"), F.max("published_date").alias("last_date"))
