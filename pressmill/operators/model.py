"""Publication, issue and article together: foreign ids, joined views, and updates of single columns.

Publications are a handful from a configuration file, so they are broadcast; issues and articles are joined by a shuffle.
Each update gives the new snapshot of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.operators.reports import is_short, long, pieces
from pressmill.operators.rescue import issue_title
from pressmill.operators.search import lead, neighbours, paragraphs


def with_publication(rows: DataFrame, publications: DataFrame) -> DataFrame:
    """``rows`` with publication_id and pub_name; rows of an unknown publication go."""
    dim = publications.select(F.col("slug").alias("pub_slug"), F.col("id").alias("publication_id"), F.col("name").alias("pub_name"))
    return rows.join(F.broadcast(dim), "pub_slug")


def with_foreign_ids(records: DataFrame, publications: DataFrame, issues: DataFrame) -> DataFrame:
    """Records that name a publication and an issue's address, with the ids of both: an unknown publication drops the record,
    an unknown issue leaves a null."""
    known = issues.select(F.col("url").alias("issue_url"), F.col("id").alias("issue_id"))
    return with_publication(records, publications).join(known, "issue_url", "left")


def joined_articles(arts: DataFrame, issues: DataFrame, publications: DataFrame) -> DataFrame:
    """Each piece with its publication and, where it has one, its issue."""
    i = issues.select(F.col("id").alias("issue_id"), F.col("number").alias("issue_number"), F.col("published_date").alias("issue_date"), F.col("url").alias("issue_url"))
    return with_publication(pieces(arts), publications).join(i, "issue_id", "left")


def article_pages(arts: DataFrame, issues: DataFrame, publications: DataFrame) -> DataFrame:
    """What the page of each piece shows: the joined row, neighbours, the number of siblings and of paragraphs."""
    per_issue = pieces(arts).where("issue_id is not null").groupBy("issue_id", "pub_slug").agg(F.count("*").alias("n"))
    rows = joined_articles(arts, issues, publications).join(neighbours(arts), "id", "left").join(per_issue, ["issue_id", "pub_slug"], "left")
    return rows.select("id", "title", "pub_name", "issue_id", "issue_number", "previous_id", "next_id", long(F.coalesce(F.col("n") - 1, F.lit(0))).alias("siblings"), long(F.size(paragraphs())).alias("paragraphs"))


def issue_volumes(arts: DataFrame, issues: DataFrame, publications: DataFrame) -> DataFrame:
    """Pieces and issues by publication of the issue."""
    i = with_publication(issues.select(F.col("id").alias("issue_id"), "pub_slug"), publications).drop("pub_slug")
    rows = pieces(arts).join(i, "issue_id")
    return rows.groupBy("pub_name").agg(long(F.count("*")).alias("n"), long(F.countDistinct("issue_id")).alias("issues"))


def leads_before(arts: DataFrame, issues: DataFrame, publications: DataFrame, slug: str, before: Column, n: int | None = None) -> DataFrame:
    """The longest piece (one without text first) of each issue of one publication before a date, newest issue first."""
    own = publications.where(F.col("slug") == slug).select(F.col("id").alias("wanted"))
    i = with_publication(issues, publications).join(F.broadcast(own), F.col("publication_id") == F.col("wanted")).where(F.col("published_date") < before)
    rows = arts.join(i.select(F.col("id").alias("issue_id"), "number", F.col("published_date").alias("issue_date")), "issue_id")
    longest = F.row_number().over(Window.partitionBy("issue_id").orderBy(F.desc_nulls_first(F.length("body")), "id"))
    found = rows.withColumn("_place", longest).where("_place = 1").select("issue_id", "number", "issue_date", "id", "title", lead(rows, 200).alias("lead"))
    return found if n is None else found.orderBy(F.desc("issue_date"), F.desc("issue_id")).limit(n)


def issues_with_partial(records: DataFrame, issues: DataFrame) -> DataFrame:
    """(url, n, partial) of issues with a document of which some article isn't whole."""
    counts = records.where("issue_url is not null").groupBy(F.col("issue_url").alias("url")).agg(long(F.count("*")).alias("n"), long(F.count_if(~F.col("is_full"))).alias("partial"))
    return issues.where("pdf_url is not null").join(counts, "url").where("partial > 0").select("url", "n", "partial")


# --- point updates ---


def rescued(arts: DataFrame, parts: DataFrame, tried: DataFrame, now: Column) -> DataFrame:
    """Articles after a rescue: those of ``parts`` (url, body, is_full) get text, flag and marker, those only ``tried`` (url) a
    marker where they have none."""
    n = parts.select("url", F.col("body").alias("_body"), F.col("is_full").alias("_full"), F.lit(True).alias("_new"))
    rows = arts.join(n, "url", "left").join(tried.select("url", F.lit(True).alias("_tried")).distinct(), "url", "left")
    marker = F.when(F.col("_new"), now).when(F.col("_tried"), F.coalesce("pdf_rescued_at", now)).otherwise(F.col("pdf_rescued_at"))
    changed = {"body": F.when(F.col("_new"), F.col("_body")).otherwise(F.col("body")), "is_full": F.when(F.col("_new"), F.col("_full")).otherwise(F.col("is_full")), "pdf_rescued_at": marker}
    return rows.select(*[changed.get(c, F.col(c)).alias(c) for c in arts.columns])


def marker_reset(arts: DataFrame) -> DataFrame:
    """Partial pieces may be tried again."""
    return arts.withColumn("pdf_rescued_at", F.when(F.col("is_full"), F.col("pdf_rescued_at")))


def updated_from_arrays(arts: DataFrame, arrays: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` replaced by the values in rows of equally long arrays (ids and one array for each column)."""
    each = arrays.select(F.explode(F.arrays_zip("ids", *[F.col(c).alias(c) for c in columns])).alias("v"))
    new = each.select(F.col("v.ids").alias("id"), *[F.col(f"v.{c}").alias(f"_{c}") for c in columns], F.lit(True).alias("_new"))
    rows = arts.join(new, "id", "left")
    return rows.select(*[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in arts.columns])


def section_rows(found: DataFrame, twins: DataFrame, issues: DataFrame, arts: DataFrame) -> DataFrame:
    """New articles from the sections (doc, issue_id, place, kicker, title, body) that have no twin, dated as the issue or
    as its newest article."""
    newest = arts.groupBy("issue_id").agg(F.max("published_date").alias("newest"))
    i = issues.select(F.col("id").alias("issue_id"), F.col("url").alias("issue_url"), F.col("published_date").alias("issue_date"))
    rows = found.join(twins.select("doc", "place"), ["doc", "place"], "left_anti").join(i, "issue_id").join(newest, "issue_id", "left")
    url = F.concat("issue_url", F.lit("#seccion-"), F.col("place").cast("string"))
    return rows.select(url.alias("url"), "issue_id", "title", F.col("kicker").alias("subtitle"), "body", F.coalesce("issue_date", "newest").alias("published_date"), F.lit(True).alias("is_full"), F.lit("seccion-pdf").alias("kind"))


def repaired_titles(arts: DataFrame, found: DataFrame, twins: DataFrame) -> DataFrame:
    """Articles whose title is only that of the issue, with the title of their section, and its kicker if it has one."""
    t = twins.select("doc", "place", "id").join(found.select("doc", "place", F.col("title").alias("_title"), F.col("kicker").alias("_kicker")), ["doc", "place"])
    one = t.groupBy("id").agg(F.min(F.struct("doc", "place", "_title", "_kicker")).alias("s"))
    rows = arts.join(one, "id", "left")
    fix = F.col("s").isNotNull() & F.coalesce(issue_title(F.col("title")), F.lit(False))
    changed = {"title": F.when(fix, F.col("s._title")).otherwise(F.col("title")), "subtitle": F.when(fix, F.coalesce(F.nullif(F.col("s._kicker"), F.lit("")), "subtitle")).otherwise(F.col("subtitle"))}
    return rows.select(*[changed.get(c, F.col(c)).alias(c) for c in arts.columns], fix.alias("repaired"))


def retagged(arts: DataFrame, tags: DataFrame) -> DataFrame:
    """(id, tags) of the articles whose tags differ from the new ones (article_id, tags)."""
    n = tags.select(F.col("article_id").alias("id"), F.col("tags").alias("_tags"))
    return arts.join(n, "id").where(~F.col("tags").eqNullSafe(F.col("_tags"))).select("id", F.col("_tags").alias("tags"))


# --- reports over the joined archive ---


def year_range(arts: DataFrame, first: int, last: int) -> DataFrame:
    return pieces(arts).where(F.year("published_date").between(first, last))


def pattern_report(arts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """How many bodies hold each pattern, in any case; _ is any one character."""
    return pieces(arts).groupBy("pub_slug").agg(*[long(F.count_if(F.ilike("body", F.lit(f"%{p}%")))).alias(name) for name, p in patterns.items()])


def ends(arts: DataFrame, word: str) -> DataFrame:
    """The last characters of each body with and without trailing blanks, its beginning, and how far before its end a word
    first stands in any case (small letters keep a text's length, capitals don't: ß)."""
    at = F.instr(F.lower("body"), word)
    right = lambda c, n: F.expr(f"right({c}, {n})")
    return pieces(arts).select("id", right("rtrim(body)", 70).alias("tail"), right("body", 190).alias("long_tail"), F.expr("left(body, 90)").alias("head"), long(F.when(at > 0, F.length("body") - at)).alias("from_end"))


def generic_extractions(arts: DataFrame, title: str, subtitle: str) -> DataFrame:
    """By year, the articles whose title or subtitle is the site's own."""
    bad = arts.where((F.col("title") == title) | F.col("subtitle").like(subtitle))
    return bad.groupBy(long(F.year("published_date")).alias("year")).agg(long(F.count("*")).alias("n"))


def samples_by_year(arts: DataFrame, n: int = 3) -> DataFrame:
    """The first pieces of each year by date; undated ones are a year of their own."""
    place = F.row_number().over(Window.partitionBy(F.year("published_date")).orderBy(F.asc_nulls_last("published_date"), "id"))
    rows = pieces(arts).where(~is_short()).select(long(F.year("published_date")).alias("year"), long(place).alias("place"), "id", "published_date", "title")
    return rows.where(F.col("place") <= n)


def slug_words(url: Column) -> Column:
    """The first three words of more than four letters in the last part of an address."""
    last = F.element_at(F.split(F.regexp_replace(url, r"/+\z", ""), "/"), -1)
    return F.slice(F.filter(F.split(last, "-"), lambda w: (F.length(w) > 4) & ~w.rlike(r"^\d+\z")), 1, 3)


def first_tag_trend(arts: DataFrame, feature: DataFrame) -> DataFrame:
    """(tag, year, n): pieces by year with the first tag of the feature piece."""
    tag = arts.join(F.broadcast(feature.select("id").limit(1)), "id", "left_semi").select(F.get("tags", F.lit(0)).alias("tag")).where("tag is not null")
    rows = pieces(arts).where("published_date is not null").join(F.broadcast(tag), F.array_contains("tags", F.col("tag")))
    return rows.groupBy("tag", long(F.year("published_date")).alias("year")).agg(long(F.count("*")).alias("n"))
