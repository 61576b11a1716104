"""A stored inverted index over articles: written once, added to without a rebuild, read by the buckets of a query's stems.

Three tables of one ``Store``: ``postings``, in folders by a hash of the stem and sorted by stem within files; ``pieces``, what
a list of results shows, without texts; ``replaced``, which ids a later version wrote again or took away. Each row says
of which version it is; a row counts if no later version replaced its piece. One commit covers all three.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.operators import search
from pressmill.operators.reports import pieces
from pressmill.sources.store import Store

BUCKETS = 64
LISTED = ("pub_slug", "issue_id", "published_date", "title")


class Index:
    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def add(self, arts: DataFrame, buckets: int = BUCKETS) -> None:
        """Index articles; those that are there already are replaced. ``buckets`` counts for the first ones."""
        rows = pieces(arts)
        with self.store.change() as change:
            version = change.before["number"] + 1
            buckets = change.notes.setdefault("buckets", buckets)
            number = F.lit(version).alias("version")
            posted = search.postings(rows).select(F.pmod(F.xxhash64("stem"), F.lit(buckets)).cast("int").alias("bucket"), "*", number)
            # a stem in every piece fills many tasks: only as much of a bucket meets as fits one
            change.append("postings", posted.hint("rebalance", "bucket").sortWithinPartitions("bucket", "stem", "id"), by=["bucket"])
            change.append("pieces", rows.select(F.col("id").cast("long"), *LISTED, number))
            if version > 1:
                known = self.store.read("pieces").select("id").distinct()
                change.append("replaced", rows.select(F.col("id").cast("long"), number).join(known, "id", "left_semi"))

    def remove(self, ids: DataFrame) -> None:
        with self.store.change() as change:
            change.append("replaced", ids.select(F.col("id").cast("long"), F.lit(change.before["number"] + 1).alias("version")))

    def _live(self, rows: DataFrame) -> DataFrame:
        if not self.store.has("replaced"):
            return rows
        last = self.store.read("replaced").groupBy("id").agg(F.max("version").alias("last"))
        return rows.join(last, "id", "left").where(F.col("last").isNull() | (F.col("version") >= F.col("last"))).drop("last")

    def pieces(self) -> DataFrame:
        return self._live(self.store.read("pieces")).select("id", *LISTED)

    def postings(self, stems: list[str]) -> DataFrame:
        """(stem, id, field, positions) of some stems, out of their buckets alone."""
        spark, buckets = self.store.spark, self.store.state()["notes"]["buckets"]
        wanted = sorted({r[0] for r in spark.range(1).select(F.explode(F.array(*map(F.lit, stems))).alias("s")).select(F.pmod(F.xxhash64("s"), F.lit(buckets)).cast("int")).collect()}) if stems else []
        rows = self.store.read("postings").where(F.col("bucket").isin(wanted) & F.col("stem").isin(stems))
        return self._live(rows).select("stem", "id", "field", "positions")

    def hits(self, query: str, **limits) -> DataFrame:
        """What a list of results shows of each piece that a query matches, with its rank; no text is read."""
        rows = search.limited(self.pieces(), **limits)
        return rows.join(search.ranked(self.postings(search.query_stems(query)), query, rows), "id")

    def view(self, arts: DataFrame, query: str, number: int = 1, size: int = 25, by_rank: bool = True, **limits) -> DataFrame:
        """One page of results in groups, with snippets. Of ``arts``, where texts lie, the pieces of the page are read."""
        shown = search.listed(self.hits(query, **limits), number, size, by_rank)
        rows = shown.collect()  # one page
        spark = self.store.spark
        texts = arts.where(F.col("id").isin([r["id"] for r in rows])).select(F.col("id").cast("long"), search.snippet(F.col("body"), search.query_stems(query, True)).alias("snippet"))
        page = spark.createDataFrame(rows, shown.schema)
        return page.join(texts, "id", "left").select("pos", "island", "id", *LISTED, "rank", "snippet").orderBy("pos")

    def years(self, queries: list[str]) -> DataFrame:
        """(query, year, n): pieces that each query matches by year, 0 where there are none, from the first year of all to
        the last."""
        spark, dated = self.store.spark, self.pieces().where("published_date is not null")
        found = [self.hits(q).where("published_date is not null").select(F.lit(q).alias("query"), F.year("published_date").alias("year")) for q in queries]
        counts = reduce(DataFrame.unionByName, found).groupBy("query", "year").agg(F.count("*").alias("n"))
        span = dated.agg(F.min(F.year("published_date")).alias("a"), F.max(F.year("published_date")).alias("b")).where("a is not null")
        grid = span.select(F.explode(F.sequence("a", "b")).alias("year")).join(F.broadcast(spark.createDataFrame([(q,) for q in queries], "query string")))
        return grid.join(counts, ["query", "year"], "left").select("query", F.col("year").cast("bigint").alias("year"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))

    def most_relevant(self, query: str, n: int = 6) -> DataFrame:
        return self.hits(query).orderBy(F.desc("rank"), F.desc_nulls_last("published_date"), F.desc("id")).limit(n)

    def compact(self) -> None:
        """One part again for each table, without what has been replaced."""
        with self.store.change() as change:
            change.replace("postings", self._live(self.store.read("postings")).select("bucket", "stem", "id", "field", "positions", "version").hint("rebalance", "bucket").sortWithinPartitions("bucket", "stem", "id"), by=["bucket"])
            change.replace("pieces", self._live(self.store.read("pieces")).select("id", *LISTED, "version"))
            change.tables.pop("replaced", None)
