"""The publication model, its updates and further reports over the stored tables, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions.text import split_tail
from pressmill.operators import enrich, entities, model, rescue, web
from pressmill.operators.merge import upsert
from pressmill.operators.reports import long
from pressmill.plans.state_queries import _REPLIED, named, replies, tailed
from pressmill.plans.state_queries import SQL as STATE_SQL
from pressmill.plans.view_queries import _NORMAL, sections
from pressmill.sources.archive import ARTICLES_SQL, articles, publications, table

PUBLICATIONS = {"weekly": "Weekly report", "bimonthly": "Bimonthly review"}


def arts(spark, d):
    return articles(table(spark, d, "documents"))


def pubs(spark):
    return publications(spark, PUBLICATIONS)


def issues(spark, d):
    """Issues made from the articles; every ninth names a publication that isn't known."""
    i = F.col("id")
    rows = arts(spark, d).where("issue_id is not null").groupBy(F.col("issue_id").alias("id")).agg(F.max("published_date").alias("newest"))
    slug = F.when(i % 9 == 0, "unknown").when(i % 4 == 0, "bimonthly").otherwise("weekly")
    return rows.select("id", F.concat(F.lit("https://archive.example/numero/"), i.cast("string")).alias("url"), i.alias("number"), slug.alias("pub_slug"), F.when(i % 13 != 0, F.col("newest")).alias("published_date"), F.when(i % 3 != 0, F.concat(F.lit("pdf/"), i.cast("string"))).alias("pdf_url"))


def records(spark, d):
    """Article records as a crawl leaves them: slug and issue address, some of them unknown."""
    i = F.col("id")
    return arts(spark, d).select("id", "url", F.when(i % 19 == 0, "nowhere").otherwise(F.col("pub_slug")).alias("pub_slug"), F.concat(F.lit("https://archive.example/numero/"), F.coalesce("issue_id", -i).cast("string")).alias("issue_url"), "is_full", "published_date")


def upsert_publications(spark, d):
    old = arts(spark, d).select(F.col("pub_slug").alias("slug")).distinct().withColumn("name", F.upper("slug"))
    new = publications(spark, {"weekly": "Weekly report", "annual": "Yearbook"}).select("slug", "name")
    return upsert(old, new, "slug", ["name"], [])


def with_issues(spark, d):
    return sections(spark, d).withColumn("issue_id", F.when(F.col("doc") % 11 != 0, F.floor(F.col("doc") / 5).cast("bigint"))).where("issue_id is not null")


def fewer(spark, d):
    """Articles, some with the issue's title, every other one with another beginning, so that sections have and lack twins."""
    title = F.when(F.col("id") % 3 == 0, F.concat(F.lit("#ISPE "), F.col("id").cast("string"), F.lit(": enero 2014"))).otherwise(F.col("title"))
    return arts(spark, d).withColumns({"title": title, "body": F.when(F.col("id") % 2 == 0, F.col("body")).otherwise(F.concat(F.lit("Otro comienzo. "), F.col("body")))})


def new_sections(spark, d):
    s, a = with_issues(spark, d), fewer(spark, d)
    s = s.withColumn("place", F.col("doc"))
    return model.section_rows(s, rescue.twins(s, a), issues(spark, d), a).select("url", "issue_id", "title", "subtitle", long(F.length("body")).alias("chars"), "published_date", "kind")


def upsert_sections(spark, d):
    s = with_issues(spark, d).withColumn("place", F.col("doc"))
    new = model.section_rows(s, rescue.twins(s, fewer(spark, d)), issues(spark, d), fewer(spark, d))
    old = new.where("length(url) % 2 = 0").withColumn("title", F.lit("old")).withColumn("published_date", F.lit(None).cast("date"))
    return upsert(old, new, "url", ["title", "subtitle", "body"], [], ["issue_id", "published_date", "kind"]).select("url", "title", "subtitle", F.md5(F.col("body").cast("binary")).alias("body"), "issue_id", "published_date", "kind")


def title_repair(spark, d):
    s, a = with_issues(spark, d), fewer(spark, d)
    return model.repaired_titles(a, s, rescue.twins(s, a)).select("id", "title", "subtitle", "repaired")


def rescue_update(spark, d):
    a = arts(spark, d).select("id", "url", "body", "is_full", F.when(F.col("id") % 7 == 0, "2023").alias("pdf_rescued_at"))
    parts = a.where("not is_full and id % 4 = 0").select("url", F.concat("body", F.lit(" rescued")).alias("body"), (F.length("body") > 600).alias("is_full"))
    out = model.rescued(a, parts, a.where("not is_full and id % 3 = 0"), F.lit("2024"))
    return out.select("id", F.md5(F.col("body").cast("binary")).alias("body"), "is_full", "pdf_rescued_at")


def rescue_reset(spark, d):
    a = arts(spark, d).select("id", "is_full", F.when(F.col("id") % 7 == 0, "2023").alias("pdf_rescued_at"))
    return model.marker_reset(a)


def bulk_tails(spark, d):
    rows = tailed(spark, d).select("id", "body", F.lit(None).cast("string").alias("trimmed_tail"))
    cut = rows.select("id", split_tail(F.col("body")).alias("s")).where("s.tail is not null")
    # arrays of bounded length, as a client would send them
    arrays = cut.groupBy(F.floor(F.col("id") / 64)).agg(F.collect_list("id").alias("ids"), F.collect_list("s.head").alias("body"), F.collect_list("s.tail").alias("trimmed_tail"))
    out = model.updated_from_arrays(rows, arrays, ["body", "trimmed_tail"])
    return out.select("id", F.md5(F.col("body").cast("binary")).alias("body"), F.md5(F.col("trimmed_tail").cast("binary")).alias("tail"))


def changed_tags(spark, d):
    tags = entities.entity_tags(entities.canonicalised(named(spark, d)))
    kept = tags.select(F.col("article_id").alias("id"), F.when(F.col("article_id") % 3 == 0, F.lit(None)).when(F.col("article_id") % 2 == 0, F.col("tags")).otherwise(F.slice("tags", 1, 3)).alias("tags"))
    return model.retagged(kept, tags).select("id", F.array_join("tags", "|").alias("tags"))


def assembled(spark, d):
    i = table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("https://archive.example/numero/"), (F.col("page_id") % 7).cast("string"))).alias("issue_url"), F.when(F.col("page_id") % 2 == 0, "2014-01-14").alias("issue_date"), (F.col("page_id") % 10 == 0).alias("missing"))
    out = web.assembled(web.article_records(table(spark, d, "pages")).join(i, "page_id"), "weekly", F.timestamp_seconds(F.lit(0)))
    return out.select("page_id", "publication", "issue_url", "published_date", "raw_html_path", F.when(F.col("status").isin("ok", "paywalled"), "read").otherwise(F.col("status")).alias("status"))


def diagnostics(spark, d):
    p = web.diagnostics(table(spark, d, "pages"))
    return p.select("page_id", "title", "og_title", "canonical", F.array_join("h1", "|").alias("h1"))


def samples(spark, d):
    e = enrich.entities(enrich.parsed(replies(spark, d)))
    rows = arts(spark, d).where("kind <> 'portada' and is_full and id % 13 <> 0 and id % 17 <> 0").select("id", F.col("published_date").alias("enriched_at"), "title")
    quotes = enrich.parsed(replies(spark, d)).where("usable").select("id", F.explode("expectativas").alias("quote"))
    return enrich.samples(rows, e, quotes, 5).select("id", "title", F.array_join("actors", ", ").alias("actors"), F.array_join("subjects", ", ").alias("subjects"), F.array_join("quotes", "|").alias("quotes"))


def slug_words(spark, d):
    url = F.concat(F.lit("https://archive.example/"), F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "-"), F.lit("/"))
    rows = arts(spark, d).select("id", "body", model.slug_words(url).alias("words"))
    there = F.size(F.filter("words", lambda w: F.contains(F.lower("body"), w)))
    return rows.select("id", F.array_join("words", " ").alias("words"), long(there).alias("present"))


QUERIES = {
    "upsert_publications": upsert_publications,
    "publication_names": lambda spark, d: model.with_publication(arts(spark, d), pubs(spark)).select("id", "publication_id", "pub_name"),
    "foreign_ids": lambda spark, d: model.with_foreign_ids(records(spark, d), pubs(spark), issues(spark, d)).select("id", "publication_id", "issue_id"),
    "joined_articles": lambda spark, d: model.joined_articles(arts(spark, d), issues(spark, d), pubs(spark)).select("id", "pub_name", "issue_number", "issue_date", "issue_url"),
    "article_pages": lambda spark, d: model.article_pages(arts(spark, d), issues(spark, d), pubs(spark)),
    "issue_volumes": lambda spark, d: model.issue_volumes(arts(spark, d), issues(spark, d), pubs(spark)),
    "leads_before": lambda spark, d: model.leads_before(arts(spark, d), issues(spark, d), pubs(spark), "weekly", F.lit("2018-06-01").cast("date")),
    "previous_leads": lambda spark, d: model.leads_before(arts(spark, d), issues(spark, d), pubs(spark), "weekly", F.lit("2018-06-01").cast("date"), 2).select("issue_id", "id"),
    "issues_with_partial": lambda spark, d: model.issues_with_partial(records(spark, d), issues(spark, d)),
    "new_sections": new_sections,
    "upsert_sections": upsert_sections,
    "title_repair": title_repair,
    "rescue_update": rescue_update,
    "rescue_reset": rescue_reset,
    "bulk_tails": bulk_tails,
    "changed_tags": changed_tags,
    "year_range": lambda spark, d: model.year_range(arts(spark, d), 2015, 2017).select("id", "published_date"),
    "pattern_report": lambda spark, d: model.pattern_report(tailed(spark, d), {"related": "art_culos relacionados", "download": "descargar pdf", "from_word": "from"}),
    "ends": lambda spark, d: model.ends(tailed(spark, d), "relacionados"),
    "generic_extractions": lambda spark, d: model.generic_extractions(arts(spark, d).withColumn("title", F.when(F.col("id") % 10 == 0, "The Archive").otherwise(F.col("title"))), "The Archive", "A%"),
    "samples_by_year": lambda spark, d: model.samples_by_year(arts(spark, d)),
    "slug_words": slug_words,
    "first_tag_trend": lambda spark, d: model.first_tag_trend(arts(spark, d), arts(spark, d).where("id = 1")),
    "assembled_records": assembled,
    "html_diagnostics": diagnostics,
    "enriched_samples": samples,
}

_PUBS = "pubs as (select * from (values (1, 'weekly', 'Weekly report'), (2, 'bimonthly', 'Bimonthly review')) t(publication_id, pub_slug, pub_name))"
_ISSUES = """issues as (select id, 'https://archive.example/numero/' || id as url, id as number, case when id % 9 = 0 then 'unknown' when id % 4 = 0 then 'bimonthly' else 'weekly' end as pub_slug,
  case when id % 13 <> 0 then newest end as published_date, case when id % 3 <> 0 then 'pdf/' || id end as pdf_url
  from (select issue_id as id, max(published_date) as newest from articles where issue_id is not null group by issue_id))"""
_RECORDS = "records as (select id, url, case when id % 19 = 0 then 'nowhere' else pub_slug end as pub_slug, 'https://archive.example/numero/' || coalesce(issue_id, -id) as issue_url, is_full, published_date from articles)"
_BASE = f"with {ARTICLES_SQL}, {_PUBS}, {_ISSUES}, {_RECORDS}"
_LEADS = """leads as (select a.issue_id, i.number, i.published_date as issue_date, a.id, a.title, coalesce(a.subtitle, substr(a.body, 1, 200)) as lead from articles a join issues i on i.id = a.issue_id
  where i.pub_slug = 'weekly' and i.published_date < date '2018-06-01' qualify row_number() over (partition by a.issue_id order by length(a.body) desc nulls first, a.id) = 1)"""
_MARK = "substr(regexp_replace(translate(lower({}), 'áàäâéèëêíìïîóòöôúùüûñç', 'aaaaeeeeiiiioooouuuunc'), '[^a-z0-9]+', '', 'g'), 1, 90)"
_FOUND = r"""found as (select *, {mark} as mark from (
  select doc_id as doc, doc_id // 5 as issue_id, upper(lang) as kicker,
    regexp_replace(regexp_replace(substr(text, 1, 40), '[ \t\x{{A0}}]+', ' ', 'g'), '^\s+|\s+$', '', 'g') as title,
    regexp_replace(regexp_replace(replace(text, chr(10), ''), '[ \t\x{{A0}}]+', ' ', 'g'), '^\s+|\s+$', '', 'g') as body
  from documents where doc_id % 11 <> 0) where length(body) >= 600),
 fewer as (select * replace (case when id % 3 = 0 then '#ISPE ' || id || ': enero 2014' else title end as title, case when id % 2 = 0 then body else 'Otro comienzo. ' || body end as body) from articles),
 pairs as (select doc, f.issue_id, a.id from found f join (select issue_id, id, {amark} as mark from fewer where issue_id is not null) a using (issue_id, mark) where length(mark) = 90 qualify count(*) over (partition by doc) = 1),
 fresh as (select i.url || '#seccion-' || doc as url, f.issue_id, title, kicker as subtitle, body, coalesce(i.published_date, n.newest) as published_date from found f join issues i on i.id = f.issue_id
   left join (select issue_id, max(published_date) as newest from fewer group by issue_id) n on n.issue_id = f.issue_id where doc not in (select doc from pairs))""".format(mark=_MARK.format("body"), amark=_MARK.format("body"))
_TAILED = "tailed as (select * replace (case when id % 3 = 0 then body || chr(10) || 'ARTÍCULOS RELACIONADOS:' || chr(10) || 'doc ' || id when id % 10 = 1 then 'Artículos relacionados' || chr(10) || body else body end as body) from articles where kind <> 'portada')"
_CUT = r"""labelled as (select *, instr(translate(lower(body), 'áàäâéèëêíìïîóòöôúùüûñç', 'aaaaeeeeiiiioooouuuunc'), 'articulos relacionados') as p from tailed),
 headed as (select *, case when p > 0 and p - 1 >= 0.5 * length(body) then substr(body, 1, p - 1) end as before from labelled),
 cut as (select *, length(regexp_replace(case when instr(reverse(before), chr(10)) > 0 then substr(before, 1, length(before) - instr(reverse(before), chr(10))) else before end, '\s+\z', '')) as cut_at from headed)"""

SQL = {
    "upsert_publications": f"with {ARTICLES_SQL}, o as (select distinct pub_slug as slug, upper(pub_slug) as name from articles), n as (select * from (values ('weekly', 'Weekly report'), ('annual', 'Yearbook')) t(slug, name)) select coalesce(n.slug, o.slug) as slug, coalesce(n.name, o.name) as name from o full outer join n on o.slug = n.slug",
    "publication_names": f"{_BASE} select id, publication_id, pub_name from articles join pubs using (pub_slug)",
    "foreign_ids": f"{_BASE} select r.id, p.publication_id, i.id as issue_id from records r join pubs p using (pub_slug) left join issues i on i.url = r.issue_url",
    "joined_articles": f"{_BASE} select a.id, p.pub_name, i.number as issue_number, i.published_date as issue_date, i.url as issue_url from pieces a join pubs p using (pub_slug) left join issues i on i.id = a.issue_id",
    "article_pages": rf"""{_BASE}, w as (select id, lag(id) over o as previous_id, lead(id) over o as next_id from pieces where published_date is not null window o as (partition by pub_slug order by published_date, id)),
 s as (select issue_id, pub_slug, count(*) - 1 as siblings from pieces where issue_id is not null group by all)
 select a.id, a.title, p.pub_name, a.issue_id, i.number as issue_number, w.previous_id, w.next_id, coalesce(s.siblings, 0) as siblings, len(list_filter(string_split(coalesce(a.body, ''), chr(10) || chr(10)), lambda x: length(trim(x)) > 0)) as paragraphs
 from pieces a join pubs p using (pub_slug) left join issues i on i.id = a.issue_id left join w on w.id = a.id left join s on s.issue_id = a.issue_id and s.pub_slug = a.pub_slug""",
    "issue_volumes": f"{_BASE} select pub_name, count(*) as n, count(distinct a.issue_id) as issues from pieces a join issues i on i.id = a.issue_id join pubs p on p.pub_slug = i.pub_slug group by pub_name",
    "leads_before": f"{_BASE}, {_LEADS} select * from leads",
    "previous_leads": f"{_BASE}, {_LEADS} select issue_id, id from leads order by issue_date desc, issue_id desc limit 2",
    "issues_with_partial": f"{_BASE}, c as (select issue_url as url, count(*) as n, count(*) filter (not is_full) as partial from records group by 1) select url, n, partial from issues join c using (url) where pdf_url is not null and partial > 0",
    "new_sections": f"{_BASE}, {_FOUND} select url, issue_id, title, subtitle, length(body) as chars, published_date, 'seccion-pdf' as kind from fresh",
    "upsert_sections": f"{_BASE}, {_FOUND} select url, title, subtitle, md5(body) as body, issue_id, case when length(url) % 2 = 1 then published_date end as published_date, 'seccion-pdf' as kind from fresh",
    "title_repair": f"{_BASE}, {_FOUND}, one as (select id, min(doc) as doc from pairs group by id), s as (select one.id, f.title as new_title, f.kicker from one join found f using (doc)) select a.id, case when a.id % 3 = 0 and s.id is not null then new_title else title end as title, case when a.id % 3 = 0 and s.id is not null then coalesce(nullif(kicker, ''), subtitle) else subtitle end as subtitle, a.id % 3 = 0 and s.id is not null as repaired from fewer a left join s on s.id = a.id",
    "rescue_update": f"with {ARTICLES_SQL} select id, md5(case when not is_full and id % 4 = 0 then body || ' rescued' else body end) as body, case when not is_full and id % 4 = 0 then length(body) > 600 else is_full end as is_full, case when not is_full and id % 4 = 0 then '2024' when id % 7 = 0 then '2023' when not is_full and id % 3 = 0 then '2024' end as pdf_rescued_at from articles",
    "rescue_reset": f"with {ARTICLES_SQL} select id, is_full, case when is_full and id % 7 = 0 then '2023' end as pdf_rescued_at from articles",
    "bulk_tails": f"with {ARTICLES_SQL}, {_TAILED}, {_CUT} select id, md5(case when cut_at is not null then substr(body, 1, cut_at) else body end) as body, case when cut_at is not null then md5(substr(body, cut_at + 1)) end as tail from cut",
    "year_range": f"with {ARTICLES_SQL} select id, published_date from pieces where year(published_date) between 2015 and 2017",
    "pattern_report": f"with {ARTICLES_SQL}, {_TAILED} select pub_slug, count(*) filter (body ilike '%art_culos relacionados%') as related, count(*) filter (body ilike '%descargar pdf%') as download, count(*) filter (body ilike '%from%') as from_word from tailed group by pub_slug",
    "ends": f"with {ARTICLES_SQL}, {_TAILED} select id, right(rtrim(body, ' '), 70) as tail, right(body, 190) as long_tail, left(body, 90) as head, case when instr(upper(body), 'RELACIONADOS') > 0 then length(body) - instr(upper(body), 'RELACIONADOS') end as from_end from tailed",
    "generic_extractions": f"with {ARTICLES_SQL} select year(published_date) as year, count(*) as n from articles where id % 10 = 0 or title = 'The Archive' or subtitle like 'A%' group by 1",
    "samples_by_year": f"with {ARTICLES_SQL} select year, place, id, published_date, title from (select *, year(published_date) as year, row_number() over (partition by year(published_date) order by published_date nulls last, id) as place from pieces where not (coalesce(body, '') = '' or length(body) < 200)) where place <= 3",
    "slug_words": rf"""with {ARTICLES_SQL}, s as (select id, lower(body) as body, list_filter(string_split(list_extract(string_split(regexp_replace('https://archive.example/' || regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g') || '/', '/+$', ''), '/'), -1), '-'), lambda w: length(w) > 4 and not regexp_matches(w, '^\d+$'))[1:3] as words from articles)
 select id, array_to_string(words, ' ') as words, len(list_filter(words, lambda w: contains(body, w))) as present from s""",
    "first_tag_trend": f"with {ARTICLES_SQL}, t as (select tags[1] as tag from articles where id = 1) select tag, year(published_date) as year, count(*) as n from pieces, t where published_date is not null and list_contains(tags, tag) group by all",
    "assembled_records": f"select page_id, case when page_id % 10 <> 0 then 'weekly' end as publication, case when page_id % 10 <> 0 and page_id % 3 <> 0 then 'https://archive.example/numero/' || (page_id % 7) end as issue_url, case when page_id % 10 <> 0 and page_id % 2 = 0 then '2014-01-14' end as published_date, case when page_id % 10 <> 0 then sha1({_NORMAL.format(u='url')}) || '.html' end as raw_html_path, case when page_id % 10 = 0 then '404' else 'read' end as status from pages",
    "changed_tags": f"with t as ({STATE_SQL['entity_tags']}) select article_id as id, tags from t where article_id % 3 = 0 or article_id % 2 <> 0 and len(string_split(tags, '|')) > 3",
    "enriched_samples": f"with {ARTICLES_SQL}, {_REPLIED} select id, title, array_to_string(list_sort(list_filter(list_distinct([word, lang]), lambda w: w <> '')), ', ') as actors, lang as subjects, quote || case when id % 4 = 0 then ' zzz' else '' end as quotes from replied where usable order by published_date desc nulls last, id limit 5",
}
