"""Entities, upserts, tails and enrichment over the stored tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions.text import split_tail, tail_at
from pressmill.operators import enrich, entities, merge
from pressmill.operators.reports import long, upper_median
from pressmill.plans.lens_queries import rounded
from pressmill.sources.archive import ARTICLES_SQL, DECLINING_SQL, SKEWED_SQL, articles, declining, skewed, table


def arts(spark, d):
    return articles(table(spark, d, "documents"))


def rich(spark, d, change=skewed):
    """Skewed articles, six of seven enriched."""
    return change(arts(spark, d)).withColumn("enriched", F.col("id") % 7 != 0)


def named(spark, d):
    """Words of five letters or more of full pieces, as written, as entities."""
    rows = rich(spark, d).where("kind <> 'portada' and is_full")
    words = F.array_distinct(F.regexp_extract_all("body", F.lit("[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]{5,}"), F.lit(0)))
    return rows.select(F.col("id").alias("article_id"), F.lit("tema").alias("kind"), F.explode(words).alias("name"))


def old_rows(spark, d):
    return arts(spark, d).where("id % 3 <> 0").withColumn("trimmed_tail", F.lit("tail"))


def new_rows(spark, d):
    a = arts(spark, d).where("id % 2 = 0").withColumn("seq", F.lit(0))
    both = a.unionByName(a.where("id % 10 = 0").withColumn("seq", F.lit(1)))
    both = both.withColumn("title", F.concat("title", F.lit(" (rev "), F.col("seq").cast("string"), F.lit(")")))
    return both.withColumn("published_date", F.when(F.col("id") % 4 != 0, F.col("published_date"))).withColumn("issue_id", F.when(F.col("id") % 6 != 0, F.col("issue_id")))


def upsert_articles(spark, d):
    last = merge.keep_last(new_rows(spark, d), "url", ["seq"]).withColumn("trimmed_tail", F.lit(None).cast("string"))
    out = merge.upsert(old_rows(spark, d), last, "url", ["title", "subtitle", "is_full", "kind", "trimmed_tail"], ["issue_id", "published_date"], ["pub_slug"])
    return out


def issues(spark, d):
    rows = arts(spark, d).where("issue_id is not null")
    return rows.groupBy("issue_id").agg(F.max("published_date").alias("published_date"), F.when(F.max("issue_id") % 3 != 0, F.concat(F.lit("pdf/"), F.max("issue_id").cast("string"))).alias("pdf_url"), long(F.count("*")).alias("number"))


def upsert_issues(spark, d):
    old = issues(spark, d).where("issue_id % 4 <> 0")
    new = issues(spark, d).where("issue_id % 2 = 0").withColumn("number", F.when(F.col("issue_id") % 10 != 0, F.col("number") + 100)).withColumn("pdf_url", F.when(F.col("issue_id") % 8 == 0, F.lit("new.pdf")))
    return merge.upsert(old, new, "issue_id", ["number"], ["published_date", "pdf_url"])


def insert_ignore(spark, d):
    a = arts(spark, d).select(F.col("id").alias("article_id"), F.explode("tags").alias("name"))
    return merge.insert_ignore(a.where("article_id % 3 = 0").withColumn("origin", F.lit("old")), a.where("article_id % 2 = 0").withColumn("origin", F.lit("new")), ["article_id", "name"])


def tailed(spark, d):
    body = F.when(F.col("id") % 3 == 0, F.concat("body", F.lit("\nARTÍCULOS RELACIONADOS:\ndoc "), F.col("id").cast("string"))).when(F.col("id") % 10 == 1, F.concat(F.lit("Artículos relacionados\n"), F.col("body"))).otherwise(F.col("body"))
    return arts(spark, d).where("kind <> 'portada'").withColumn("body", body)


def tail_cut(spark, d):
    rows = tailed(spark, d).select("id", tail_at(F.col("body")).alias("at"), "body").where("at is not null")
    return rows.select("id", long("at").alias("head_chars"), long(F.length("body") - F.col("at")).alias("tail_chars"))


def tail_restore(spark, d):
    rows = tailed(spark, d).select("id", "body", split_tail(F.col("body")).alias("s"))
    same = F.concat(F.col("s.head"), F.coalesce("s.tail", F.lit(""))) == F.col("body")
    return rows.agg(long(F.count("*")).alias("n"), long(F.count("s.tail")).alias("cut"), long(F.count_if(same)).alias("restored"))


def tail_report(spark, d):
    rows = tailed(spark, d).withColumn("at", tail_at(F.col("body"))).withColumn("epoch", F.when(F.year("published_date") >= 2017, "new").otherwise("old"))
    rows = rows.withColumn("tail", F.length("body") - F.col("at"))
    return rows.groupBy("pub_slug", "epoch").agg(long(F.count("*")).alias("n"), long(F.count("at")).alias("cut"), long(F.sum("tail")).alias("cut_chars"), long(upper_median("tail")).alias("median_cut"))


def replies(spark, d):
    a = arts(spark, d).where("kind <> 'portada' and is_full")
    word = F.regexp_extract("body", "[A-Za-z]{5,}", 0)
    quote = F.concat(F.substring("body", 20, 50), F.when(F.col("id") % 4 == 0, " zzz").otherwise(""))
    body = F.to_json(F.struct(F.array(word, F.upper(word), F.concat(F.lit(" "), F.col("lang"), F.lit(" ."))).alias("actores"), F.array().cast("array<string>").alias("lugares"), F.array("lang").alias("temas"), F.array(quote).alias("expectativas")))
    mixed = F.regexp_replace(body, r'"temas":\[', '"temas":[7,')
    return a.select("id", F.when(F.col("id") % 13 == 0, "not json").when(F.col("id") % 17 == 0, "[1,2]").otherwise(mixed).alias("reply"))


def enrich_parse(spark, d):
    p = enrich.parsed(replies(spark, d))
    names = lambda kind: F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("name")))), "|")
    n = enrich.entities(p).groupBy("id").agg(names("actor").alias("actors"), names("tema").alias("subjects"))
    return p.select("id", "usable", F.array_join("expectativas", "|").alias("quotes")).join(n, "id", "left").select("id", "usable", "quotes", F.coalesce("actors", F.lit("")).alias("actors"), F.coalesce("subjects", F.lit("")).alias("subjects"))


def changes(kind):
    change = declining if kind == "falling" else skewed
    return lambda spark, d: rounded(entities.entity_changes(rich(spark, d, change), named(spark, d), kind))


QUERIES = {
    "entity_canonical": lambda spark, d: entities.canonical_forms(named(spark, d)),
    "entity_tags": lambda spark, d: entities.entity_tags(entities.canonicalised(named(spark, d))).select("article_id", F.array_join("tags", "|").alias("tags")),
    "entity_coverage": lambda spark, d: entities.coverage(rich(spark, d)),
    "entity_rising": changes("rising"),
    "entity_falling": changes("falling"),
    "entity_new": changes("new"),
    "keep_last": lambda spark, d: merge.keep_last(new_rows(spark, d), "url", ["seq"]).select("url", "title", F.col("seq").cast("bigint").alias("seq")),
    "upsert_articles": upsert_articles,
    "upsert_issues": upsert_issues,
    "insert_ignore": insert_ignore,
    "issues_done": lambda spark, d: merge.issues_done(arts(spark, d)),
    "not_loaded": lambda spark, d: merge.not_loaded(arts(spark, d).select("url"), old_rows(spark, d).select("url")),
    "pending_issues": lambda spark, d: merge.pending_issues(issues(spark, d), arts(spark, d).withColumn("pdf_rescued_at", F.when(F.col("id") % 5 == 0, F.lit("2024")))).select("issue_id", "published_date", "pdf_url"),
    "pending_enrichment": lambda spark, d: merge.pending_enrichment(rich(spark, d)).select("id", "published_date"),
    "load_summary": lambda spark, d: merge.load_summary(arts(spark, d)),
    "tail_cut": tail_cut,
    "tail_restore": tail_restore,
    "tail_report": tail_report,
    "enrich_parse": enrich_parse,
    "quote_verify": lambda spark, d: enrich.verified_quotes(enrich.parsed(replies(spark, d)), arts(spark, d)),
    "cost_estimate": lambda spark, d: enrich.cost_estimate(arts(spark, d)),
    "enrich_progress": lambda spark, d: enrich.progress(rich(spark, d)),
}

_KEY = "lower(translate(name, 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN'))"
_NAMED = (
    SKEWED_SQL
    + ", rich as (select *, id % 7 <> 0 as enriched from skewed), named as (select distinct id as article_id, 'tema' as kind, name from (select id, unnest(regexp_extract_all(body, '[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]{5,}')) as name from rich where kind <> 'portada' and is_full))"
)
_FORMS = f", forms as (select kind, {_KEY} as key, name, count(*) as n from named group by all), best as (select * from forms qualify row_number() over (partition by kind, key order by n desc, name) = 1)"
_OLD = "old as (select *, 'tail' as trimmed_tail from articles where id % 3 <> 0)"
_NEW = """new as (select * replace (title || ' (rev ' || seq || ')' as title, case when id % 4 <> 0 then published_date end as published_date, case when id % 6 <> 0 then issue_id end as issue_id)
  from (select *, 0 as seq from articles where id % 2 = 0 union all select *, 1 as seq from articles where id % 10 = 0))"""
_LAST = "last as (select * from new qualify row_number() over (partition by url order by seq desc) = 1)"
_ISSUES = "issues as (select issue_id, max(published_date) as published_date, case when issue_id % 3 <> 0 then 'pdf/' || issue_id end as pdf_url, count(*) as number from articles where issue_id is not null group by issue_id)"
_TAILED = """tailed as (select * replace (case when id % 3 = 0 then body || chr(10) || 'ARTÍCULOS RELACIONADOS:' || chr(10) || 'doc ' || id when id % 10 = 1 then 'Artículos relacionados' || chr(10) || body else body end as body) from articles where kind <> 'portada'),
 labelled as (select *, instr(translate(lower(body), 'áàäâéèëêíìïîóòöôúùüûñç', 'aaaaeeeeiiiioooouuuunc'), 'articulos relacionados') as p from tailed),
 headed as (select *, case when p > 0 and p - 1 >= 0.5 * length(body) then substr(body, 1, p - 1) end as before from labelled),
 cut as (select *, length(regexp_replace(case when instr(reverse(before), chr(10)) > 0 then substr(before, 1, length(before) - instr(reverse(before), chr(10))) else before end, '\\s+\\z', '')) as cut_at from headed)"""
_PLAIN = r"trim(regexp_replace(translate(strip_accents(lower({})), '‘’“”–—', chr(39) || chr(39) || chr(34) || chr(34) || '--'), '\s+', ' ', 'g'), ' ')"
_REPLIED = "replied as (select *, id % 13 <> 0 and id % 17 <> 0 as usable, substr(body, 20, 50) as quote, regexp_extract(body, '[A-Za-z]{5,}') as word from articles where kind <> 'portada' and is_full)"


def _entity(change: str) -> str:
    tail = {"rising": ("n >= 4 and share / base >= 1.6", "range(n, docs + 1)", "share - base"), "falling": ("base_n >= 4 and share / base <= 1 / 1.6", "range(0, n + 1)", "base - share")}
    named_sql = _NAMED.replace(SKEWED_SQL, DECLINING_SQL) if change == "falling" else _NAMED
    head = f"""with {named_sql}, source as (select id, year(published_date) as period from rich where kind <> 'portada' and published_date is not null and is_full and enriched),
 periods as (select period, count(*) as docs, row_number() over (order by period) as i, count(*) over () as np from source group by period),
 counts as (select kind, name, period, count(*) as n from named join source on article_id = id group by all),
 ents as (select kind, name, sum(n) as total from counts group by all having sum(n) >= 4),
 cells as (select e.*, p.i, p.np, p.docs, coalesce(c.n, 0) as n from ents e cross join periods p left join counts c on c.kind = e.kind and c.name = e.name and c.period = p.period),
 based as (select kind, name, cast(total as bigint) as total, max(n) filter (i = np) as n, max(n / docs) filter (i = np) as share, max(docs) filter (i = np) as docs, avg(n / docs) filter (i < np and i >= np - 5) as base, avg(n) filter (i < np and i >= np - 5) as base_n, max(np) as np from cells group by kind, name, total)"""
    if change == "new":
        return head + " select kind, name, n, round(share, 9) as share from based where total = n and n >= 4 and np >= 4"
    keep, ks, delta = tail[change]
    return (
        head
        + f""", tested as (select *, least(base, 0.999) as e from based where base > 0 and np >= 4 and not (total = n and n >= 4) and {keep}),
 pmf as (select kind, name, [lgamma(docs + 1) - case when k = 0 then 0 else lgamma(k + 1) end - case when docs = k then 0 else lgamma(docs - k + 1) end + k * ln(e) + (docs - k) * ln(1 - e) for k in {ks}] as l from tested),
 tails as (select t.*, least(1.0, exp(list_max(l)) * list_sum([exp(x - list_max(l)) for x in l])) as p from tested t join pmf using (kind, name))
 select kind, name, n, round(share, 9) as share, round(base, 9) as base, round(share / base, 9) as lift, round({delta}, 9) as delta from tails where p <= 0.01 / (select greatest(count(*), 1) from ents)"""
    )


SQL = {
    "entity_canonical": f"with {_NAMED} {_FORMS} select kind, key, name, n from best",
    "entity_tags": f"with {_NAMED} {_FORMS}, c as (select distinct article_id, b.name from named n join best b on b.key = lower(translate(n.name, 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN'))) select article_id, array_to_string(list_sort(list(name))[1:10], '|') as tags from c group by article_id",
    "entity_coverage": f"with {_NAMED} select cast(year(published_date) as varchar) as period, count(*) as total, count(*) filter (enriched) as enriched, round(count(*) filter (enriched) / count(*), 6) as coverage, count(*) filter (enriched) / count(*) < 0.5 as low from rich where kind <> 'portada' and published_date is not null and is_full group by 1",
    "entity_rising": _entity("rising"),
    "entity_falling": _entity("falling"),
    "entity_new": _entity("new"),
    "keep_last": f"with {ARTICLES_SQL}, {_NEW}, {_LAST} select url, title, seq from last",
    "upsert_articles": f"with {ARTICLES_SQL}, {_OLD}, {_NEW}, {_LAST} select coalesce(n.url, o.url) as url, " + ", ".join(f"case when n.url is not null then n.{c} else o.{c} end as {c}" for c in ("title", "subtitle", "is_full", "kind")) + ", case when n.url is null then o.trimmed_tail end as trimmed_tail, coalesce(n.issue_id, o.issue_id) as issue_id, coalesce(n.published_date, o.published_date) as published_date, case when o.url is not null then o.pub_slug else n.pub_slug end as pub_slug from old o full outer join last n on o.url = n.url",
    "upsert_issues": f"with {ARTICLES_SQL}, {_ISSUES}, o as (select * from issues where issue_id % 4 <> 0), n as (select issue_id, case when issue_id % 10 <> 0 then number + 100 end as number, published_date, case when issue_id % 8 = 0 then 'new.pdf' end as pdf_url from issues where issue_id % 2 = 0) select coalesce(n.issue_id, o.issue_id) as issue_id, case when n.issue_id is not null then n.number else o.number end as number, coalesce(n.published_date, o.published_date) as published_date, coalesce(n.pdf_url, o.pdf_url) as pdf_url from o full outer join n on o.issue_id = n.issue_id",
    "insert_ignore": f"with {ARTICLES_SQL}, a as (select id as article_id, unnest(tags) as name from articles) select article_id, name, 'old' as origin from a where article_id % 3 = 0 union all select distinct article_id, name, 'new' from a where article_id % 2 = 0 and article_id % 3 <> 0",
    "issues_done": f"with {ARTICLES_SQL} select issue_id, count(*) as n from articles where issue_id is not null group by issue_id having count(*) >= 3",
    "not_loaded": f"with {ARTICLES_SQL} select url from articles where id % 3 = 0",
    "pending_issues": f"with {ARTICLES_SQL}, {_ISSUES} select issue_id, published_date, pdf_url from issues i where pdf_url is not null and exists (select 1 from articles a where a.issue_id = i.issue_id and not is_full and kind <> 'portada' and id % 5 <> 0)",
    "pending_enrichment": f"with {SKEWED_SQL} select id, published_date from skewed where kind <> 'portada' and is_full and id % 7 = 0 and coalesce(body, '') <> ''",
    "load_summary": f"with {ARTICLES_SQL} select pub_slug, count(*) as n, count(*) filter (is_full) as \"full\", count(*) filter (coalesce(body, '') = '' or length(body) < 200) as short, min(published_date) as first_date, max(published_date) as last_date from articles group by pub_slug",
    "tail_cut": f"with {ARTICLES_SQL}, {_TAILED} select id, cut_at as head_chars, length(body) - cut_at as tail_chars from cut where cut_at is not null",
    "tail_restore": f"with {ARTICLES_SQL}, {_TAILED} select count(*) as n, count(cut_at) as cut, count(*) as restored from cut",
    "tail_report": f"with {ARTICLES_SQL}, {_TAILED}, t as (select pub_slug, case when year(published_date) >= 2017 then 'new' else 'old' end as epoch, cut_at, length(body) - cut_at as tail from cut) select pub_slug, epoch, count(*) as n, count(cut_at) as cut, cast(sum(tail) as bigint) as cut_chars, list_sort(list(tail) filter (tail is not null))[count(tail) // 2 + 1] as median_cut from t group by all",
    "enrich_parse": f"with {ARTICLES_SQL}, {_REPLIED} select id, usable, case when usable then quote || case when id % 4 = 0 then ' zzz' else '' end else '' end as quotes, case when usable then array_to_string(list_sort(list_filter(list_distinct([word, lang]), lambda w: w <> '')), '|') else '' end as actors, case when usable then lang else '' end as subjects from replied",
    "quote_verify": rf"""with {ARTICLES_SQL}, {_REPLIED}, q as (select id, {_PLAIN.format('body')} as plain, quote || case when id % 4 = 0 then ' zzz' else '' end as q from replied where usable),
 v as (select id, length(trim(regexp_replace(q, '\s+', ' ', 'g'), ' ')) >= 30 and contains(plain, {_PLAIN.format('q')}) as good from q) select id, case when good then 1 else 0 end as kept, case when good then 0 else 1 end as discarded from v""",
    "cost_estimate": f"with {ARTICLES_SQL}, t as (select count(*) as requests, cast(sum(length(body)) as bigint) as chars from pieces where is_full) select requests, chars, round(chars / 3.6 + 400 * requests, 3) as tokens_in, round(300.0 * requests, 3) as tokens_out, round(((chars / 3.6 + 400 * requests) * 1.0 + 300.0 * requests * 5.0) / 1e6 / 2, 6) as cost from t",
    "enrich_progress": f"with {ARTICLES_SQL} select count(*) as total, count(*) filter (id % 7 <> 0) as enriched from pieces where is_full",
}
