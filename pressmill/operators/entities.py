"""Entities of articles: canonical names, tags, and what rises, falls or is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.functions.stats import binomial_tail
from pressmill.functions.text import fold_name
from pressmill.operators.lens import ALPHA, BASE_LEAST, BASE_MOST, LIFT
from pressmill.operators.reports import long

SUPPORT = 4


def canonical_forms(entities: DataFrame) -> DataFrame:
    """(kind, key, name) with the commonest written form of each folded name; of forms as common the first by name."""
    counted = entities.select("kind", "name", fold_name(F.col("name")).alias("key")).groupBy("kind", "key", "name").agg(F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy("kind", "key").orderBy(F.desc("n"), F.asc("name")))
    return counted.withColumn("place", best).where("place = 1").select("kind", "key", "name", "n")


def canonicalised(entities: DataFrame) -> DataFrame:
    """(article_id, kind, name) with every variant written in its canonical form, once for an article."""
    forms = canonical_forms(entities).select("kind", "key", F.col("name").alias("canonical"))
    rows = entities.withColumn("key", fold_name(F.col("name"))).join(forms, ["kind", "key"])
    return rows.select("article_id", "kind", F.col("canonical").alias("name")).distinct()


def entity_tags(entities: DataFrame, kinds: tuple[str, ...] = ("tema", "lugar"), most: int = 10) -> DataFrame:
    """The first ten names of an article in alphabetical order."""
    return entities.where(F.col("kind").isin(*kinds)).groupBy("article_id").agg(F.slice(F.array_sort(F.collect_set("name")), 1, most).alias("tags"))


def coverage(arts: DataFrame) -> DataFrame:
    """By period: full dated pieces, those enriched, the share, and whether it is too low to trust."""
    rows = arts.where((F.col("kind") != "portada") & F.col("published_date").isNotNull() & F.col("is_full"))
    found = rows.groupBy(F.year("published_date").cast("string").alias("period")).agg(long(F.count("*")).alias("total"), long(F.count_if("enriched")).alias("enriched"))
    share = F.col("enriched") / F.col("total")
    return found.select("period", "total", "enriched", F.round(share, 6).alias("coverage"), (share < 0.5).alias("low"))


def entity_changes(arts: DataFrame, entities: DataFrame, change: str) -> DataFrame:
    """Entities that are ``rising``, ``falling`` or ``new`` in the last enriched period. Counts and denominators are both
    of full enriched pieces, so that no share is above one."""
    rows = arts.where((F.col("kind") != "portada") & F.col("published_date").isNotNull() & F.col("is_full") & F.col("enriched")).select(F.col("id").alias("article_id"), F.year("published_date").cast("string").alias("period"))
    sizes = sorted((r["period"], r["n"]) for r in rows.groupBy("period").agg(F.count("*").alias("n")).collect())
    periods, docs = [p for p, _ in sizes], [n for _, n in sizes]
    k, last = min(BASE_MOST, len(periods) - 1), len(periods) - 1
    if k < BASE_LEAST:
        return arts.sparkSession.createDataFrame([], "kind string, name string, n bigint, share double, base double, lift double, delta double")
    counts = entities.join(rows, "article_id").groupBy("kind", "name").agg(F.array(*[F.count_if(F.col("period") == p) for p in periods]).alias("ns"))
    ns = F.col("ns")
    share = lambda i: ns[i] / F.lit(float(docs[i]))
    total, n = F.aggregate("ns", F.lit(0).cast("bigint"), lambda s, x: s + x), ns[last]
    base = sum((share(i) for i in range(last - k, last)), F.lit(0.0)) / k
    base_n = sum((ns[i] for i in range(last - k, last)), F.lit(0)) / k
    table = counts.select("kind", "name", "ns", total.alias("total"), n.alias("n"), share(last).alias("share"), base.alias("base"), base_n.alias("base_n"))
    fresh = (F.col("total") == F.col("n")) & (F.col("n") >= SUPPORT)
    if change == "new":
        return table.where(fresh).select("kind", "name", "n", "share")
    examined = table.agg(F.greatest(F.count_if(F.col("total") >= SUPPORT), F.lit(1)).alias("examined"))
    lift = F.col("share") / F.col("base")
    up = change == "rising"
    rows = table.where(~fresh & (F.col("base") > 0)).withColumn("lift", lift)
    rows = rows.where((F.col("n") >= SUPPORT) & (F.col("lift") >= LIFT)) if up else rows.where((F.col("base_n") >= SUPPORT) & (F.col("lift") <= 1 / LIFT))
    p = binomial_tail(F.col("n"), F.lit(docs[last]), F.least(F.col("base"), F.lit(0.999)), up)
    rows = rows.withColumn("p", p).join(F.broadcast(examined)).where(F.col("p") <= ALPHA / F.col("examined"))
    delta = F.col("share") - F.col("base") if up else F.col("base") - F.col("share")
    return rows.select("kind", "name", "n", "share", "base", "lift", delta.alias("delta"))
