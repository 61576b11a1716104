"""The archive model (publication, issue, article) over stored tables, and readers and writers of its files."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

ARTICLE_RECORD = StructType(
    [StructField(c, StringType()) for c in ("url", "kind", "title", "subtitle", "published_date", "body", "publication", "issue_url", "raw_html_path", "scraped_at", "source")]
    + [StructField("authors", ArrayType(StringType())), StructField("tags", ArrayType(StringType())), StructField("is_full", BooleanType())]
)
ISSUE_RECORD = StructType(
    [StructField(c, StringType()) for c in ("url", "title", "published_date", "pdf_url", "publication")] + [StructField("number", IntegerType()), StructField("article_urls", ArrayType(StringType()))]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines; a missing path gives no rows, blank lines are skipped, a malformed line raises."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def publications(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """The publications dimension (id, slug, name) from a configuration of names by slug."""
    return spark.createDataFrame([(k + 1, slug, name) for k, (slug, name) in enumerate(names.items())], "id int, slug string, name string")


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """(path, html) of stored pages; bytes that aren't UTF-8 are replaced."""

    def decoded(content: pd.Series) -> pd.Series:
        return content.map(lambda b: bytes(b).decode("utf-8", "replace"))

    return spark.read.format("binaryFile").load(path).select("path", F.pandas_udf(decoded, "string")("content").alias("html"))


def html_key(url: str = "url"):
    """The name a page is stored under."""
    return F.concat(F.sha1(F.col(url).cast("binary")), F.lit(".html"))


def numbered_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, slug, number) of files named <slug>-<number>.pdf."""
    name = F.regexp_extract("path", r"([^/]+)\z", 1)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", name.alias("name"))
    return found.where(F.col("name").rlike(r"^.+-\d+\.pdf\z")).select("path", F.regexp_extract("name", r"^(.+)-\d+\.pdf\z", 1).alias("slug"), F.regexp_extract("name", r"-(\d+)\.pdf\z", 1).cast("int").alias("number"))


def ensure_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns that are missing are added as nulls; those there stay."""
    return reduce(lambda d, f: d if f.name in d.columns else d.withColumn(f.name, F.lit(None).cast(f.dataType)), schema.fields, df)


def articles(documents: DataFrame) -> DataFrame:
    """Articles made from the documents table."""
    i = F.col("doc_id")
    return documents.select(
        i.alias("id"),
        F.when(i % 5 == 0, "bimonthly").otherwise("weekly").alias("pub_slug"),
        F.when(i % 11 != 0, F.floor(i / 5).cast("bigint")).alias("issue_id"),
        F.concat(F.lit("https://archive.example/"), F.when(i % 2 == 0, "articulo-completo/").otherwise("articulo/"), i.cast("string")).alias("url"),
        F.substring("text", 1, 60).alias("title"),
        F.when(i % 3 == 0, F.substring("text", 1, 120)).alias("subtitle"),
        F.when(i % 7 == 0, F.array().cast("array<string>")).when(i % 4 == 0, F.array("source", "lang")).otherwise(F.array("source")).alias("authors"),
        F.array("lang", F.concat(F.lit("q"), (F.col("n_chars") % 5).cast("string"))).alias("tags"),
        F.when(i % 97 != 0, F.make_date((2014 + i % 6).cast("int"), (1 + i * 11 % 12).cast("int"), (1 + i * 7 % 28).cast("int"))).alias("published_date"),
        F.col("text").alias("body"),
        (F.col("n_chars") >= 1200).alias("is_full"),
        F.when(i % 23 == 0, "portada").otherwise("articulo").alias("kind"),
        F.col("lang"),
    )


def skewed(arts: DataFrame) -> DataFrame:
    """The same articles with most of one language dated to the last year, so that its words rise."""
    year = F.when((F.col("lang") == "es") & (F.col("id") % 3 != 0), 2019).otherwise(F.year("published_date"))
    return arts.withColumn("published_date", F.when(F.col("published_date").isNotNull(), F.make_date(year, F.month("published_date"), F.dayofmonth("published_date"))))


def declining(arts: DataFrame) -> DataFrame:
    """The same articles with those of one language dated to all years but the last, so that its words fall."""
    year = F.when(F.col("lang") == "en", 2014 + F.col("id") % 5).otherwise(F.year("published_date")).cast("int")
    return arts.withColumn("published_date", F.when(F.col("published_date").isNotNull(), F.make_date(year, F.month("published_date"), F.dayofmonth("published_date"))))


ARTICLES_SQL = """
articles as (
  select doc_id as id, case when doc_id % 5 = 0 then 'bimonthly' else 'weekly' end as pub_slug,
    case when doc_id % 11 <> 0 then doc_id // 5 end as issue_id,
    'https://archive.example/' || case when doc_id % 2 = 0 then 'articulo-completo/' else 'articulo/' end || doc_id as url,
    substr(text, 1, 60) as title, case when doc_id % 3 = 0 then substr(text, 1, 120) end as subtitle,
    case when doc_id % 7 = 0 then cast([] as varchar[]) when doc_id % 4 = 0 then [source, lang] else [source] end as authors,
    [lang, 'q' || (n_chars % 5)] as tags,
    case when doc_id % 97 <> 0 then make_date(2014 + doc_id % 6, 1 + doc_id * 11 % 12, 1 + doc_id * 7 % 28) end as published_date,
    text as body, n_chars >= 1200 as is_full, case when doc_id % 23 = 0 then 'portada' else 'articulo' end as kind, lang
  from documents
), pieces as (select * from articles where kind <> 'portada')
"""

SKEWED_SQL = (
    ARTICLES_SQL
    + """, skewed as (
  select * replace (case when published_date is not null then make_date(
    case when lang = 'es' and id % 3 <> 0 then 2019 else year(published_date) end, month(published_date), day(published_date)) end as published_date)
  from articles
)
"""
)

DECLINING_SQL = (
    ARTICLES_SQL
    + """, skewed as (
  select * replace (case when published_date is not null then make_date(
    case when lang = 'en' then 2014 + id % 5 else year(published_date) end, month(published_date), day(published_date)) end as published_date)
  from articles
)
"""
)
