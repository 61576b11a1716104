"""What a crawl and an enrichment have done so far, as tables of one ``Store``: each step is one commit over all the tables
it touches, so that an article is never marked as enriched without its names, and a step that stops is done again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.operators import enrich, merge
from pressmill.operators.reports import long
from pressmill.sources.archive import html_key
from pressmill.sources.store import Store, shared_place

BATCH = "id string, model string, n_requests long, created_at timestamp, collected_at timestamp, n_ok long, n_error long"


def kept(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder, for steps that read them several times."""
    path = shared_place(rows.sparkSession, "kept")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Enrichments:
    """Tables ``articles`` (with enriched_at, enrichment_model), ``entities``, ``quotes`` and ``batches``."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def begin(self, arts: DataFrame) -> None:
        spark = self.store.spark
        with self.store.change() as change:
            change.replace("articles", arts.withColumns({"enriched_at": F.lit(None).cast("timestamp"), "enrichment_model": F.lit(None).cast("string")}))
            change.replace("entities", spark.createDataFrame([], "id long, kind string, name string"))
            change.replace("quotes", spark.createDataFrame([], "id long, quote string"))
            change.replace("batches", spark.createDataFrame([], BATCH))

    def pending(self) -> DataFrame:
        rows = self.store.read("articles").withColumn("enriched", F.col("enriched_at").isNotNull())
        return merge.pending_enrichment(rows).drop("enriched")

    def sent(self, batch: str, model: str, n_requests: int, at: Column) -> None:
        """Note a batch; one that is noted already stays as it is."""
        rows = self.store.read("batches")
        new = self.store.spark.range(1).select(F.lit(batch).alias("id"), F.lit(model).alias("model"), F.lit(n_requests).cast("long").alias("n_requests"), at.cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("collected_at"), F.lit(None).cast("long").alias("n_ok"), F.lit(None).cast("long").alias("n_error"))
        with self.store.change() as change:
            change.replace("batches", merge.insert_ignore(rows, new, ["id"]))

    def open_batches(self) -> DataFrame:
        return self.store.read("batches").where("collected_at is null").orderBy("created_at", "id")

    def collect(self, batch: str, results: DataFrame, at: Column) -> None:
        """Take in the results (custom_id, status, reply) of a batch: names, quotes that stand in the text, tags and marks of
        the articles, and the batch's counts. A batch that was collected before is left alone."""
        arts, batches = self.store.read("articles"), self.store.read("batches")
        noted = batches.where((F.col("id") == batch) & F.col("collected_at").isNull()).select("model").first()
        if noted is None:
            return
        ours = kept(enrich.ours(results))
        replies = kept(enrich.parsed(ours.where(F.col("status") == "succeeded").select("id", "reply").join(arts.select("id"), "id", "left_semi")))
        good = replies.where("usable")
        quotes = enrich.good_quotes(good, arts).select("id", F.explode("quotes").alias("quote")).distinct()
        tags = good.select("id").join(enrich.enrichment_tags(good), "id", "left").select("id", F.coalesce("tags", F.array().cast("array<string>")).alias("new_tags"))
        changed = arts.join(tags, "id", "left")
        there = F.col("new_tags").isNotNull()
        columns = {"tags": F.when(there, F.col("new_tags")).otherwise(F.col("tags")), "enriched_at": F.when(there, at.cast("timestamp")).otherwise(F.col("enriched_at")), "enrichment_model": F.when(there, F.lit(noted["model"])).otherwise(F.col("enrichment_model"))}
        counts = ours.join(good.select("id", F.lit(True).alias("fine")), "id", "left").agg(long(F.count("fine")).alias("ok"), long(F.count("*") - F.count("fine")).alias("error"))
        mine = F.col("id") == batch
        done = {"collected_at": F.when(mine, at.cast("timestamp")).otherwise(F.col("collected_at")), "n_ok": F.when(mine, F.col("ok")).otherwise(F.col("n_ok")), "n_error": F.when(mine, F.col("error")).otherwise(F.col("n_error"))}
        with self.store.change() as change:
            change.replace("entities", merge.insert_ignore(self.store.read("entities"), enrich.entities(good).select(F.col("id").cast("long"), "kind", "name"), ["id", "kind", "name"]))
            change.replace("quotes", merge.insert_ignore(self.store.read("quotes"), quotes.select(F.col("id").cast("long"), "quote"), ["id", "quote"]))
            change.replace("articles", changed.select(*[columns.get(c, F.col(c)).alias(c) for c in arts.columns]))
            change.replace("batches", batches.join(F.broadcast(counts)).select(*[done.get(c, F.col(c)).alias(c) for c in batches.columns]))  # one row

    def progress(self) -> DataFrame:
        return enrich.progress(self.store.read("articles").withColumn("enriched", F.col("enriched_at").isNotNull()))


class Crawl:
    """Tables ``issues`` (url, published_date, articles), ``records`` (url, status) and ``html`` (key, url, html, read_at), in
    folders by the first two letters of the key: what has been read."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def note(self, issues: DataFrame | None = None, records: DataFrame | None = None) -> None:
        """Issues read with the addresses of their articles, and articles read; both in one commit. What is known stays."""
        with self.store.change() as change:
            for name, rows in (("issues", issues), ("records", records)):
                if rows is not None:
                    known = self.store.read(name) if self.store.has(name) else None
                    change.append(name, rows.dropDuplicates(["url"]) if known is None else rows.dropDuplicates(["url"]).join(known, "url", "left_anti"))

    def unread_issues(self, found: DataFrame) -> DataFrame:
        """Of found addresses (url) of issues those not read yet."""
        return found.select("url").distinct().join(self.store.read("issues"), "url", "left_anti") if self.store.has("issues") else found.select("url").distinct()

    def targets(self) -> DataFrame:
        """(url, issue_url, issue_date) of the articles of all issues read that aren't read themselves, each once."""
        rows = self.store.read("issues").select(F.explode("articles").alias("article"), F.col("url").alias("issue_url"), F.col("published_date").alias("issue_date"))
        rows = rows.groupBy("article").agg(F.min(F.struct("issue_url", "issue_date")).alias("issue")).select(F.col("article").alias("url"), "issue.issue_url", "issue.issue_date")
        return rows.join(self.store.read("records"), "url", "left_anti") if self.store.has("records") else rows

    def save_html(self, pages: DataFrame, at: Column) -> None:
        """Keep pages (url, html) as they came, under the hash of their address; a page read again is kept beside."""
        rows = pages.select(html_key("url").alias("key"), "url", "html", at.cast("timestamp").alias("read_at"))
        with self.store.change() as change:
            change.append("html", rows.withColumn("folder", F.substring("key", 1, 2)), by=["folder"])

    def html(self, urls: DataFrame | None = None) -> DataFrame:
        """(key, url, html) of all addresses, or of some, as last read."""
        rows = self.store.read("html")
        if urls is not None:
            wanted = urls.select(html_key("url").alias("key")).distinct()
            rows = rows.join(wanted.withColumn("folder", F.substring("key", 1, 2)), ["folder", "key"], "left_semi")
        return rows.groupBy("key").agg(F.max_by(F.struct("url", "html"), F.struct("read_at", "html")).alias("last")).select("key", "last.url", "last.html")
