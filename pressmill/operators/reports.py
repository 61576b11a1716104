"""Reports on an archive: volumes, coverage, lengths, titles, tags, authors, markers. All take articles as ``arts``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import TAIL_LABEL, fold_label, fold_marker, tail_at, words_in


def pieces(arts: DataFrame) -> DataFrame:
    """Articles without the covers of issues."""
    return arts.where(F.col("kind") != "portada")


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def count(condition: Column | None = None) -> Column:
    return long(F.count("*") if condition is None else F.count_if(condition))


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, rounded down."""
    return long(F.floor(part * 100 / F.greatest(whole, F.lit(1))))


def mentions(arts: DataFrame, word: str) -> DataFrame:
    return pieces(arts).where(F.col("published_date").isNotNull() & F.array_contains(words_in("body"), word))


def trend_quarterly(arts: DataFrame, word: str) -> DataFrame:
    quarter = F.date_trunc("quarter", "published_date").cast("date")
    return mentions(arts, word).groupBy(quarter.alias("quarter"), "pub_slug").agg(count().alias("n"))


def trend_yearly(arts: DataFrame, word: str) -> DataFrame:
    return mentions(arts, word).groupBy(long(F.year("published_date")).alias("year")).agg(count().alias("n"))


def trend_year_grid(arts: DataFrame, words: list[str]) -> DataFrame:
    """Mentions of each word in each year from the first to the last, 0 where there are none."""
    dated = pieces(arts).where("published_date is not null").select(long(F.year("published_date")).alias("year"), words_in("body").alias("found"))
    counts = dated.select("year", F.explode(F.array_distinct(F.filter("found", lambda w: w.isin(words)))).alias("word")).groupBy("year", "word").agg(count().alias("n"))
    span = dated.agg(F.min("year").alias("a"), F.max("year").alias("b")).where("a is not null")
    grid = span.select(F.explode(F.sequence("a", "b")).alias("year"), F.array(*map(F.lit, words)).alias("words")).select("year", F.explode("words").alias("word"))
    return grid.join(counts, ["year", "word"], "left").select("year", "word", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def pub_summary(arts: DataFrame) -> DataFrame:
    return pieces(arts).groupBy("pub_slug").agg(
        count().alias("n"),
        long(F.countDistinct("issue_id")).alias("issues"),
        F.min("published_date").alias("first_date"),
        F.max("published_date").alias("last_date"),
        long(F.sum(F.length("body"))).alias("chars"),
        long(F.round(F.avg(F.length("body").cast("decimal(18,0)")))).alias("mean_chars"),
    )


def inventory_totals(arts: DataFrame) -> DataFrame:
    return arts.agg(
        count().alias("records"),
        count(F.col("kind") != "portada").alias("pieces"),
        count((F.col("kind") != "portada") & F.col("is_full")).alias("full"),
        count((F.col("kind") != "portada") & ~F.col("is_full")).alias("partial"),
        count(F.col("published_date").isNull()).alias("undated"),
        count(F.col("issue_id").isNull()).alias("unissued"),
        long(F.countDistinct("issue_id")).alias("issues"),
    )


def metadata_coverage(arts: DataFrame) -> DataFrame:
    n = F.count("*")
    return pieces(arts).groupBy("pub_slug").agg(
        percent(F.count("subtitle"), n).alias("subtitle_pct"),
        percent(F.count_if(F.size("authors") > 0), n).alias("authors_pct"),
        percent(F.count_if(F.size("tags") > 0), n).alias("tags_pct"),
        percent(F.count("published_date"), n).alias("dated_pct"),
        percent(F.count("issue_id"), n).alias("issue_pct"),
    )


def year_by_publication(arts: DataFrame, slugs: tuple[str, ...] = ("bimonthly", "weekly")) -> DataFrame:
    return pieces(arts).where("published_date is not null").groupBy(long(F.year("published_date")).alias("year")).agg(*[count(F.col("pub_slug") == s).alias(s) for s in slugs])


def form(url: str = "url") -> Column:
    return F.when(F.col(url).contains("/articulo-completo/"), "complete").otherwise("plain")


def epoch(year: int, date: str = "published_date") -> Column:
    return F.when(F.year(date) >= year, "new").otherwise("old")


def length_percentiles(arts: DataFrame, year: int) -> DataFrame:
    """Discrete percentiles of the length of full pieces."""
    shares = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9}
    length = F.length("body")
    rows = pieces(arts).where("published_date is not null").select(epoch(year).alias("epoch"), form().alias("form"), length.alias("len"), "is_full")
    exact = [F.expr(f"cast(percentile_disc({p}) within group (order by len) as bigint)").alias(k) for k, p in shares.items()]
    full = F.expr("coalesce(cast(percentile_disc(0.5) within group (order by len) filter (where is_full) as bigint), 0)").alias("full_p50")
    return rows.groupBy("epoch", "form").agg(count().alias("n"), *exact, full)


def upper_median(values: str) -> Column:
    """Of two middle values the larger."""
    return F.expr(f"percentile_disc(0.5) within group (order by {values} desc)")


# Labels of other lists of links that are counted, not cut.
OTHER_LABELS = ("te puede interesar", "lee tambien", "leer mas", "mas sobre", "articulos recientes", "sigue leyendo")


def tail_counters(arts: DataFrame, label: str = TAIL_LABEL, others: tuple[str, ...] = OTHER_LABELS) -> DataFrame:
    """(counter, n) over bodies that aren't cut yet: how many are cut, how many are spared since their label stands in the
    first half, and in how many each other label is seen."""
    rows = arts.where("body is not null").select("body", fold_label(F.col("body")).alias("plain"))
    has, cut = F.contains("plain", F.lit(label)), tail_at(F.col("body"), label).isNotNull()
    counts = {"cut": F.count_if(cut), "protected": F.count_if(has & ~cut)} | {o: F.count_if(F.contains("plain", F.lit(o))) for o in others}
    one = rows.agg(*[c.alias(f"n{k}") for k, c in enumerate(counts.values())])
    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("counter"), long(f"n{k}").alias("n")) for k, name in enumerate(counts)])).alias("x")).select("x.counter", "x.n")


def size_by_epoch_form(arts: DataFrame, year: int, limit: int = 3000) -> DataFrame:
    size = F.when(F.length("body") < limit, "short").otherwise("long")
    return pieces(arts).where("published_date is not null").groupBy(epoch(year).alias("epoch"), form().alias("form"), size.alias("size")).agg(count().alias("n"))


def closing_punctuation(arts: DataFrame, limit: int = 3000) -> DataFrame:
    """How bodies end, after trailing blanks: closed by punctuation, in an ellipsis, or open."""
    end = F.expr("trim(trailing ' \\t\\r\\n' from body)")
    size = F.when(F.length("body") < limit, "short").otherwise("long")
    return pieces(arts).groupBy(size.alias("size")).agg(
        count().alias("n"),
        count(end.rlike("[.!?»\"”)]\\z")).alias("closed"),
        count(end.rlike("(\\.\\.\\.|…)\\z")).alias("ellipsis"),
        count(~end.rlike("[.!?»\"”)…]\\z")).alias("open"),
    )


def pieces_per_issue(arts: DataFrame) -> DataFrame:
    """Pieces, issues and their ratio by year and publication; pieces without an issue don't count."""
    rows = pieces(arts).where("published_date is not null and issue_id is not null")
    n, issues = F.count("*").cast("decimal(18,6)"), F.countDistinct("issue_id").cast("decimal(18,6)")
    return rows.groupBy(long(F.year("published_date")).alias("year"), "pub_slug").agg(count().alias("n"), long(F.countDistinct("issue_id")).alias("issues"), F.round(n / issues, 1).cast("double").alias("ratio"))


def repeated_titles(arts: DataFrame, more_than: int = 2, top: int = 8) -> DataFrame:
    return pieces(arts).groupBy("title").agg(count().alias("n")).where(F.col("n") > more_than).orderBy(F.desc("n"), F.asc("title")).limit(top)


def is_short(body: str = "body", limit: int = 200) -> Column:
    return (F.coalesce(F.col(body), F.lit("")) == "") | (F.length(body) < limit)


def short_bodies(arts: DataFrame) -> DataFrame:
    return pieces(arts).groupBy("pub_slug").agg(count(is_short()).alias("short"), count(~is_short()).alias("rest"), count(F.col("url").startswith("http")).alias("with_url"))


def is_generic_title(title: Column, exact: tuple[str, ...], prefixes: tuple[str, ...], pattern: str) -> Column:
    """Empty, one of the set, a breadcrumb, or of a corporate prefix, after white space and case are folded."""
    plain = F.lower(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)\s+", " ")))
    found = (plain == "") | plain.isin(*exact) | plain.rlike(rf"^(?:{pattern})\z")
    for p in prefixes:
        found = found | plain.startswith(p)
    return found


def generic_titles(arts: DataFrame, exact: tuple[str, ...], prefixes: tuple[str, ...], pattern: str) -> DataFrame:
    return pieces(arts).where(is_generic_title(F.col("title"), exact, prefixes, pattern)).select("id", "title")


def top_tags_year(arts: DataFrame, top: int = 7) -> DataFrame:
    """The tags of the last year that most pieces have, with their share of the largest count."""
    dated = pieces(arts).where("published_date is not null").select(F.year("published_date").alias("year"), "tags")
    last = dated.agg(F.max("year").alias("last"))
    counted = dated.join(F.broadcast(last), F.col("year") == F.col("last")).select(F.explode("tags").alias("tag")).groupBy("tag").agg(count().alias("n")).orderBy(F.desc("n"), F.asc("tag")).limit(top)
    return counted.join(F.broadcast(counted.agg(F.max("n").alias("most")))).select("tag", "n", long(F.floor(F.col("n") * 100 / F.col("most"))).alias("share"))


def top_authors(arts: DataFrame, top: int = 10) -> DataFrame:
    return pieces(arts).select(F.explode("authors").alias("author")).groupBy("author").agg(count().alias("n")).orderBy(F.desc("n"), F.asc("author")).limit(top)


def new_authors(arts: DataFrame, year: int) -> DataFrame:
    """Authors whose first dated piece is of the year, and how many pieces they have in it."""
    signed = pieces(arts).where("published_date is not null").select(F.explode("authors").alias("author"), F.year("published_date").alias("year"))
    return signed.where("author is not null").groupBy("author").agg(F.min("year").alias("first"), count(F.col("year") == year).alias("n")).where(F.col("first") == year).select("author", "n")


def signed_docs(arts: DataFrame) -> DataFrame:
    """By year: pieces, pieces with an author, different authors."""
    rows = pieces(arts).where("published_date is not null").select("id", F.year("published_date").alias("year"), F.explode_outer("authors").alias("author"))
    return rows.groupBy(long("year").alias("year")).agg(
        long(F.countDistinct("id")).alias("pieces"), long(F.countDistinct(F.when(F.col("author").isNotNull(), F.col("id")))).alias("signed"), long(F.countDistinct("author")).alias("authors")
    )


def marker_prevalence(arts: DataFrame, markers: list[str]) -> DataFrame:
    """Share of the full pieces of a year that hold each marker, accents and case folded; one scan for all markers."""
    rows = pieces(arts).where("published_date is not null and is_full").select(long(F.year("published_date")).alias("year"), fold_marker(F.col("body")).alias("plain"))
    hits = rows.select("year", F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), F.col("plain").contains(fold_marker(F.lit(m))).alias("hit")) for m in markers])).alias("h"))
    return hits.groupBy("year", F.col("h.marker").alias("marker")).agg(count().alias("docs"), count(F.col("h.hit")).alias("n"), percent(F.count_if("h.hit"), F.count("*")).alias("pct"))


def mean_words(arts: DataFrame) -> DataFrame:
    return pieces(arts).groupBy("pub_slug").agg(F.round(F.avg(F.size(F.split(F.coalesce("body", F.lit("")), r"\s+"))), 6).alias("mean_words"))
