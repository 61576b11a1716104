"""Steps of crawl, rescue and enrichment, addresses, folds and trends over the stored tables, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions import folds
from pressmill.functions.addresses import resolved
from pressmill.functions.stemmer import stems
from pressmill.functions.text import clean_pdf
from pressmill.operators import enrich, lens, reports, rescue, states, web
from pressmill.operators.reports import long
from pressmill.plans.lens_queries import sql as lens_sql
from pressmill.plans.state_queries import _REPLIED, replies
from pressmill.plans.view_queries import _FORMS, _WORDS, _has, _rank, arts, issue_texts, stored_index
from pressmill.sources.archive import ARTICLES_SQL, table
from pressmill.sources.store import shared_place

MOMENT = "2024-05-06 07:08:09"


def enriched(spark, d):
    """Two batches over the pieces that wait: replies of those with even ids, then of all; the second can change nothing of
    what the first has stored."""
    done = states.Enrichments(spark, shared_place(spark, "enriched"))
    done.begin(arts(spark, d))
    results = replies(spark, d).select(F.concat(F.lit("art-"), F.col("id").cast("string")).alias("custom_id"), F.when(F.col("id") % 19 == 0, "errored").otherwise("succeeded").alias("status"), "reply")
    results = results.unionByName(results.limit(1).withColumn("custom_id", F.lit("other-1")))
    for k, rows in enumerate((results.where("try_cast(substring(custom_id, 5) as bigint) % 2 = 0"), results)):
        done.sent(f"batch-{k}", "model", 100 + k, F.lit(MOMENT))
        done.collect(f"batch-{k}", rows, F.lit(MOMENT))
    return done


def enrich_saved(spark, d):
    store = enriched(spark, d).store
    names = store.read("entities").groupBy("id").agg(long(F.count("*")).alias("names"))
    quotes = store.read("quotes").groupBy("id").agg(long(F.count("*")).alias("quotes"))
    rows = store.read("articles").join(names, "id", "left").join(quotes, "id", "left")
    return rows.select("id", F.array_join("tags", "|").alias("tags"), F.col("enriched_at").isNotNull().alias("enriched"), F.coalesce("names", F.lit(0)).cast("bigint").alias("names"), F.coalesce("quotes", F.lit(0)).cast("bigint").alias("quotes"))


def enrich_batches(spark, d):
    return enriched(spark, d).store.read("batches").select("id", "model", "n_requests", F.col("collected_at").cast("string").alias("collected_at"), "n_ok", "n_error")


def enrich_waiting(spark, d):
    return enriched(spark, d).pending().select("id")


def enrich_requests(spark, d):
    rows = enrich.requests(arts(spark, d).where("kind <> 'portada' and is_full"), "Cataloga.", "model", 500)
    doc = F.try_parse_json("request")
    got = lambda path, kind="string": F.try_variant_get(doc, path, kind)
    return rows.select("custom_id", got("$.model").alias("model"), got("$.max_tokens", "bigint").alias("most"), F.md5(got("$.messages[0].content").cast("binary")).alias("content"), F.array_join(got("$.output_config.format.schema.required", "array<string>"), ",").alias("required"), got("$.output_config.format.schema.properties.temas.items.type").alias("kind"))


def enrich_ingestion(spark, d):
    results = replies(spark, d).select(F.concat(F.lit("art-"), F.col("id").cast("string")).alias("custom_id"), F.when(F.col("id") % 19 == 0, "errored").otherwise("succeeded").alias("status"), "reply")
    return enrich.ingestion(results)


def crawled(spark, d):
    """A crawl over the issues of articles: issues of two thirds are read, of their articles every fourth; then the rest of the
    issues again with other articles for those known."""
    crawl = states.Crawl(spark, shared_place(spark, "crawl"))
    rows = arts(spark, d).where("issue_id is not null")
    issues = rows.groupBy(F.concat(F.lit("https://archive.example/numero/"), F.col("issue_id").cast("string")).alias("url")).agg(F.max("published_date").alias("published_date"), F.array_sort(F.collect_list("url")).alias("articles"), F.max("issue_id").alias("k"))
    records = rows.where("id % 4 = 0").select("url", F.lit("ok").alias("status"))
    crawl.note(issues.where("k % 3 <> 0").drop("k"), records)
    crawl.note(issues.where("k % 6 <> 0").withColumn("articles", F.when(F.col("k") % 3 == 0, F.col("articles")).otherwise(F.array(F.lit("https://archive.example/no")))).drop("k"), None)
    return crawl, issues


def crawl_targets(spark, d):
    return crawled(spark, d)[0].targets()


def crawl_unread(spark, d):
    crawl, issues = crawled(spark, d)
    return crawl.unread_issues(issues)


def references(spark, d):
    """References of many forms on each page, resolved against its address."""
    refs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r).alias("ref")) for k, r in enumerate(("x", "./y?z=1", "../up", "../../../top", "//other.example/a//b", "/root/./p/../q", "?page=2", "#part", "https://full.example/m/../n", "mailto:a@b.example", "d/", ".."))])
    rows = table(spark, d, "pages").select("page_id", "url", F.explode(refs).alias("r"))
    return rows.select("page_id", F.col("r.k").alias("k"), resolved(F.col("r.ref"), F.col("url")).alias("address"))


def listed_pages(spark, d):
    """The stored pages with a list's links around them: some to the next page in the archive, some elsewhere."""
    next_link = F.when(F.col("page_id") % 4 == 0, "<link rel='next' href='/archivo/2020/page/2/'>").when(F.col("page_id") % 4 == 1, "<div class='nav-links'><a class='next page-numbers' href='../archivo/3'>n</a></div>").when(F.col("page_id") % 4 == 2, "<a rel='next' href='/2023/page/2/'>n</a>").otherwise("")
    number = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("<div class='ctaSubscriptionsTitle'>Número del <b>"), (1 + F.col("page_id") % 28).cast("string"), F.lit(" de mayo</b> de 2021</div><a href='/f/download.php?id="), F.col("page_id").cast("string"), F.lit("'>PDF</a>"))).otherwise("")
    url = F.concat(F.regexp_replace("url", "[?#].*", ""), F.when(F.col("page_id") % 5 != 0, F.format_string("/numero-%04d/", "page_id")).otherwise(""))
    return table(spark, d, "pages").select("page_id", url.alias("url"), F.concat(next_link, F.lit("<h1> </h1>"), number, F.coalesce("html", F.lit(""))).alias("html"))


def html_issues(spark, d):
    return web.issue_records(listed_pages(spark, d)).select("page_id", "number", "published_date", "pdf_url", F.col("title").endswith(F.concat(F.lit(" "), F.col("number").cast("string"))).alias("numbered"))


def html_reparse_counts(spark, d):
    fresh = web.article_records(table(spark, d, "pages"))
    old = fresh.select("url", F.when(F.col("page_id") % 3 == 0, "Portal").when(F.col("page_id") % 3 == 1, F.lit("Other")).otherwise(F.col("title")).alias("title"))
    return web.reparse_counts(old.dropDuplicates(["url"]), fresh.where("page_id % 5 <> 0").dropDuplicates(["url"]), ("portal",), only_generic=True)


def html_headings(spark, d):
    rows = web.diagnostics(table(spark, d, "pages").withColumn("html", F.concat("html", F.lit("<h2>One</h2><h2>Two "), F.col("page_id").cast("string"), F.lit("</h2>"))))
    return rows.select("page_id", F.array_join("h2", "|").alias("h2"), F.array_join("slug", "|").alias("slug"), "slug_found")


LETTERS = "".join(map(chr, range(192, 256))), "".join(map(chr, range(256, 306))), "".join(map(chr, range(7680, 7770)))
ODD = " || ' ½ ﬁ ' || ".join(f"substr('{x}', cast(1 + id % {len(x)} as int), 1)" for x in LETTERS)


def folded(spark, d):
    """Titles with letters of the Latin blocks, folded in three ways."""
    title = F.concat(F.col("title"), F.expr(ODD))
    return arts(spark, d).select("id", folds.fold_alnum(title).alias("alnum"), F.md5(folds.fold_quote(title).cast("binary")).alias("quote"), F.md5(folds.decomposed(F.col("body")).cast("binary")).alias("body"))


def rescue_parts(spark, d):
    return rescue.rescued(issue_texts(spark, d), arts(spark, d).where("issue_id is not null").withColumn("body", F.substring("body", 1, 100))).select("issue_id", "id", "chars", "is_full")


def rescue_states(spark, d):
    rows = arts(spark, d).where("issue_id is not null").withColumn("body", F.substring("body", 1, 100))
    texts = issue_texts(spark, d).withColumn("text", F.when(F.col("issue_id") % 4 == 0, F.substring("text", 1, 1199)).otherwise(F.col("text")))
    return rescue.rescue_states(texts, rows)


def pdf_clean(spark, d):
    text = F.regexp_replace(F.col("body"), "e n", "e-\nn")
    return arts(spark, d).select("id", F.md5(clean_pdf(text).cast("binary")).alias("text"))


def lexemes(spark, d):
    """How many different stems the words of all pieces have, and how many different words."""
    words = arts(spark, d).where("kind <> 'portada'").select(F.explode(F.regexp_extract_all(F.lower("body"), F.lit(r"(?U)\w+"), F.lit(0))).alias("word")).distinct()
    return words.withColumn("stem", stems("word")).agg(long(F.countDistinct("stem")).alias("lexemes"), long(F.count("*")).alias("words"))


def sections_many(spark, d):
    """Texts set as many sections: a title before every four lines that aren't empty, a kicker before every other title, and
    before every third a second title, which goes with the first."""
    lines = F.filter(F.split("text", "\n"), lambda t: F.length(t) > 0)
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(lines).alias("line", "text")).withColumn("part", F.floor(F.col("line") / 4).cast("int") + 1)
    piece = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    n = F.col("part").cast("string")
    heads = F.when(F.col("line") % 4 == 0, F.concat(F.when(F.col("part") % 2 == 0, F.array(piece("antetitulo", F.concat(F.lit(" K "), n)))).otherwise(F.array().cast("array<struct<kind:string,text:string>>")), F.array(piece("titular", F.concat(F.lit("Parte "), n))), F.when(F.col("part") % 3 == 0, F.array(piece("titular", F.lit(" bis")))).otherwise(F.array().cast("array<struct<kind:string,text:string>>"))))
    every = F.concat(F.coalesce(heads, F.array().cast("array<struct<kind:string,text:string>>")), F.array(piece("cuerpo", F.col("text"))))
    fragments = rows.select("doc", "line", F.posexplode(every).alias("k", "f")).select("doc", (F.col("line") * 4 + F.col("k")).alias("seq"), "f.kind", "f.text")
    return rescue.sections(fragments)


TERMS = ["from with", "eine -clown"]

QUERIES = {
    "enrich_saved": enrich_saved,
    "enrich_batches": enrich_batches,
    "enrich_waiting": enrich_waiting,
    "enrich_requests": enrich_requests,
    "enrich_ingestion": enrich_ingestion,
    "crawl_targets": crawl_targets,
    "crawl_unread": crawl_unread,
    "resolved_addresses": references,
    "html_next_pages": lambda spark, d: web.next_pages(listed_pages(spark, d)),
    "html_issues": html_issues,
    "html_reparse_counts": html_reparse_counts,
    "html_headings": html_headings,
    "folded_titles": folded,
    "rescue_parts": rescue_parts,
    "rescue_states": rescue_states,
    "pdf_clean": pdf_clean,
    "sections_many": sections_many,
    "lexemes": lexemes,
    "tail_counters": lambda spark, d: reports.tail_counters(with_labels(spark, d)),
    "trend_years": lambda spark, d: stored_index(spark, d).years(TERMS),
    "trend_relevant": lambda spark, d: stored_index(spark, d).most_relevant(TERMS[0]).select("id", "title", "published_date", "rank"),
    "corpus_discarded": lambda spark, d: lens.discarded(arts(spark, d), "weekly", 2016),
    "density_half_years": lambda spark, d: lens.period_density(lens.corpus(arts(spark, d), half_years=True, pub="weekly", since=2016)),
    "term_examples": lambda spark, d: lens.examples(lens.corpus(arts(spark, d)), "from with", 5).select("id", "date"),
}


def with_labels(spark, d):
    label = F.when(F.col("id") % 6 == 0, "\nTe puede interesar: x").when(F.col("id") % 5 == 0, "\nLEE TAMBIÉN y sigue leyendo").otherwise("")
    late = F.when(F.col("id") % 7 == 0, "\nArtículos relacionados\nx").otherwise("")
    early = F.when(F.col("id") % 11 == 0, "Artículos relacionados. ").otherwise("")
    return arts(spark, d).withColumn("body", F.concat(early, F.col("body"), label, late))


_SAVED = f"""{_REPLIED}, won as (select *, usable and id % 19 <> 0 as good from replied)"""
_FOLDED = "lower(strip_accents(replace(replace(replace(replace({}, '½', '1⁄2'), 'ﬁ', 'fi'), 'Ĳ', 'IJ'), 'ĳ', 'ij')))"
_ISSUE_TEXTS = "t as (select issue_id, string_agg(title || chr(10) || body, chr(10) order by id) as text from articles where issue_id is not null group by issue_id)"
_LETTERS = r"regexp_replace(strip_accents(lower({})), '[^\p{{L}}\p{{N}}]+', '', 'g')"


def _parts(text: str) -> str:
    """(issue_id, id, part) of the texts that are long enough."""
    return rf"""{_ISSUE_TEXTS}, u as (select issue_id, {text} as text from t),
 g as (select issue_id, text, list_filter(list_transform(string_split(text, ''), lambda x, i: case when regexp_matches(x, '[\p{{L}}\p{{N}}]') then i end), lambda i: i is not null) as places, {_LETTERS.format('text')} as plain from u where length(text) >= 1200),
 a as (select issue_id, id, is_full, {_LETTERS.format('title')} as mark, count(*) over (partition by issue_id) = 1 as alone from articles where issue_id is not null),
 l as (select a.*, g.text, g.places, case when length(mark) >= 10 then coalesce(nullif(instr(plain, mark), 0), case when length(mark) >= 40 then nullif(instr(plain, substr(mark, 1, 40)), 0) end, case when length(mark) >= 30 then nullif(instr(plain, substr(mark, 1, 30)), 0) end, case when length(mark) >= 22 then nullif(instr(plain, substr(mark, 1, 22)), 0) end) end as spot from a join g using (issue_id)),
 s as (select *, case when alone then 0 else places[spot] - 1 end as start from l where alone or spot is not null),
 e as (select *, coalesce(lead(start) over (partition by issue_id order by start, id), length(text)) as stop from s),
 better as (select issue_id, id, length(regexp_replace(substr(text, start + 1, stop - start), '^\s+|\s+$', '', 'g')) as chars from e where not is_full)"""


_ROOT, _FOLDER = "regexp_extract(url, '^(https?://[^/?#]*)', 1)", "regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(https?://[^/]*/(?:.*/)?)', 1)"
_UP = f"case when {_FOLDER} = {_ROOT} || '/' then {_FOLDER} else regexp_replace({_FOLDER}, '[^/]*/$', '') end"

SQL = {
    "enrich_saved": f"""with {ARTICLES_SQL}, {_SAVED} select a.id, case when good then a.lang else array_to_string(a.tags, '|') end as tags, coalesce(good, false) as enriched,
 case when good then 2 + case when w.word <> '' then 1 else 0 end else 0 end as names, case when good and a.id % 4 <> 0 then 1 else 0 end as quotes
 from articles a left join won w on w.id = a.id""",
    "enrich_batches": f"with {ARTICLES_SQL}, {_SAVED} select 'batch-' || k as id, 'model' as model, 100 + k as n_requests, '{MOMENT}' as collected_at, count(*) filter (good) as n_ok, count(*) filter (not good) as n_error from won, (select unnest([0, 1]) as k) where k = 1 or id % 2 = 0 group by k",
    "enrich_waiting": f"with {ARTICLES_SQL}, {_SAVED} select id from won where not good and coalesce(body, '') <> ''",
    "enrich_requests": f"with {ARTICLES_SQL} select 'art-' || id as custom_id, 'model' as model, 500 as most, md5('TÍTULO: ' || title || chr(10) || chr(10) || 'TEXTO:' || chr(10) || body) as content, 'actores,lugares,temas,expectativas' as required, 'string' as kind from pieces where is_full",
    "enrich_ingestion": f"with {ARTICLES_SQL}, {_REPLIED} select count(*) filter (id % 19 <> 0 and usable) as ok, count(*) filter (id % 19 = 0) as error, count(*) filter (id % 19 <> 0 and not usable) as unusable from replied",
    "crawl_targets": f"with {ARTICLES_SQL}, i as (select issue_id, max(published_date) as issue_date from articles where issue_id is not null group by 1) select url, 'https://archive.example/numero/' || issue_id as issue_url, issue_date from articles join i using (issue_id) where issue_id % 6 <> 0 and id % 4 <> 0",
    "crawl_unread": f"with {ARTICLES_SQL} select distinct 'https://archive.example/numero/' || issue_id as url from articles where issue_id % 6 = 0",
    "resolved_addresses": f"""select page_id, k, case k when 0 then {_FOLDER} || 'x' when 1 then {_FOLDER} || 'y?z=1' when 2 then {_UP} || 'up' when 3 then {_ROOT} || '/top' when 4 then regexp_extract(url, '^(https?:)', 1) || '//other.example/a//b'
 when 5 then {_ROOT} || '/root/q' when 6 then regexp_replace(url, '[?#].*$', '') || '?page=2' when 7 then regexp_replace(url, '#.*$', '') || '#part' when 8 then 'https://full.example/n' when 9 then 'mailto:a@b.example' when 10 then {_FOLDER} || 'd/' else {_UP} end as address
 from pages, (select unnest(range(12))::int as k)""",
    "html_next_pages": f"""with p as (select page_id, regexp_replace(url, '[?#].*', '') || case when page_id % 5 <> 0 then '/numero-' || lpad(page_id::varchar, 4, '0') || '/' else '' end as url from pages)
 select page_id, case when page_id % 4 = 0 then {_ROOT} || '/archivo/2020/page/2/' else {_UP} || 'archivo/3' end as next from p where page_id % 4 in (0, 1)""",
    "html_issues": r"""with p as (select page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) as root, case when page_id % 5 <> 0 then page_id else try_cast(regexp_extract(regexp_replace(url, '[?#].*', ''), '-(\d+)/?$', 1) as bigint) end as number from pages)
 select page_id, number::int as number, case when page_id % 3 = 0 then '2021-05-' || lpad((1 + page_id % 28)::varchar, 2, '0') end as published_date, case when page_id % 3 = 0 then root || '/f/download.php?id=' || page_id end as pdf_url, case when number is not null then true end as numbered from p""",
    "html_headings": r"""with p as (select page_id, html, list_slice(list_filter(string_split(list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1), '-'), lambda w: length(w) > 4 and not regexp_matches(w, '^\d+$')), 1, 3) as slug from pages)
 select page_id, 'One|Two ' || page_id as h2, array_to_string(slug, '|') as slug, len(list_filter(slug, lambda w: contains(lower(html), lower(w)))) as slug_found from p""",
    "folded_titles": rf"""with {ARTICLES_SQL}, o as (select id, body, title || {ODD} as title from articles)
 select id, regexp_replace({_FOLDED.format('title')}, '[^a-z0-9]+', '', 'g') as alnum, md5(trim(regexp_replace(translate({_FOLDED.format('title')}, '‘’“”–—', '''''""--'), '\s+', ' ', 'g'), ' ')) as quote, md5(strip_accents(body)) as body from o""",
    "rescue_parts": f"with {ARTICLES_SQL}, {_parts('text')} select issue_id, id, chars, chars >= 1200 as is_full from better where chars > 400",
    "rescue_states": f"""with {ARTICLES_SQL}, {_parts('case when issue_id % 4 = 0 then substr(text, 1, 1199) else text end')}, n as (select issue_id, count(*) filter (not is_full) as tried from articles where issue_id is not null group by 1), b as (select issue_id, count(*) as better from better where chars > 400 group by 1)
 select u.issue_id, case when length(text) >= 1200 then 'ok' else 'sin-texto' end as status, case when length(text) >= 1200 then tried else 0 end as tried, coalesce(better, 0) as better from u join n using (issue_id) left join b using (issue_id)""",
    "sections_many": r"""with l as (select doc_id as doc, list_filter(string_split(text, chr(10)), lambda t: length(t) > 0) as ls from documents), e as (select doc, unnest(ls) as t, generate_subscripts(ls, 1) - 1 as line from l),
 s as (select doc, cast(line // 4 + 1 as bigint) as place, string_agg(t, '' order by line) as b from e group by 1, 2),
 c as (select doc, place, case when place % 2 = 0 then 'K ' || place else '' end as kicker, 'Parte ' || place || case when place % 3 = 0 then ' bis' else '' end as title,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(b, chr(173), ''), '([\p{L}\p{N}_])-\s+([a-záéíóúüñ])', '\1\2', 'g'), '([\p{L}\p{N}_])-\s+([a-záéíóúüñ])', '\1\2', 'g'), '[ \t\x{A0}]+', ' ', 'g'), '^\s+|\s+$', '', 'g') as body from s)
 select doc, place, kicker, title, body from c where length(body) >= 600""",
    "pdf_clean": rf"""with {ARTICLES_SQL}, o as (select id, regexp_replace(replace(replace(replace(body, 'e n', 'e-' || chr(10) || 'n'), chr(13), ''), chr(173), ''), '([\p{{L}}\p{{N}}_])-\n([\p{{L}}\p{{N}}_])', '\1\2', 'g') as t from articles)
 select id, md5(trim(regexp_replace(regexp_replace(replace(regexp_replace(t, '\n{{2,}}', chr(1), 'g'), chr(10), ' '), '[ \t]+', ' ', 'g'), ' ?\x01 ?', chr(10) || chr(10), 'g'), ' ')) as text from o""",
    "tail_counters": f"""with {ARTICLES_SQL}, b as (select id % 6 = 0 as other, id % 5 = 0 and id % 6 <> 0 as also, case when id % 11 = 0 then 'Artículos relacionados. ' else '' end || body || case when id % 6 = 0 then chr(10) || 'Te puede interesar: x' when id % 5 = 0 then chr(10) || 'LEE TAMBIÉN y sigue leyendo' else '' end
   || case when id % 7 = 0 then chr(10) || 'Artículos relacionados' || chr(10) || 'x' else '' end as body from articles),
 o as (select other, also, length(body) as n, instr(strip_accents(lower(body)), 'articulos relacionados') as p from b)
 select * from (select 'cut' as counter, count(*) filter (p > 0 and p - 1 >= 0.5 * n) as n from o union all select 'protected', count(*) filter (p > 0 and p - 1 < 0.5 * n) from o union all select 'te puede interesar', count(*) filter (other) from o
 union all select unnest(['lee tambien', 'sigue leyendo']), (select count(*) filter (also) from o) union all select unnest(['leer mas', 'mas sobre', 'articulos recientes']), 0)""",
    "trend_years": f"""with {ARTICLES_SQL}, {_WORDS}, y as (select unnest(range(min(year(published_date)), max(year(published_date)) + 1)) as year from pieces), q as (select unnest(['from with', 'eine -clown']) as query),
 h as (select year(published_date) as year, {_has('from')} and {_has('with')} as a, {_has('eine')} and not {_has('clown')} as b from words)
 select query, y.year, count(*) filter (case when query = 'from with' then a else b end) as n from y cross join q left join h on h.year = y.year group by all""",
    "trend_relevant": f"with {ARTICLES_SQL}, {_WORDS} select id, title, published_date, {_rank(['from', 'with'])} as rank from words where {_has('from')} and {_has('with')} order by rank desc, published_date desc nulls last, id desc limit 6",
    "corpus_discarded": f"with {ARTICLES_SQL} select count(*) filter (not is_full) as discarded from pieces where pub_slug = 'weekly' and year(published_date) >= 2016",
    "density_half_years": lens_sql(ARTICLES_SQL, "(select * from articles where pub_slug = 'weekly' and year(published_date) >= 2016)", "select s.period || case when month(a.published_date) <= 6 then '-S1' else '-S2' end as period, count(distinct s.id) as docs, round(count(f.term) / count(distinct s.id), 6) as density from source s join articles a using (id) left join found f using (id) group by 1"),
    "term_examples": lens_sql(ARTICLES_SQL, "articles", "select id, published_date as date from articles where id in (select id from found where term = 'from with') order by published_date desc, id desc limit 5"),
}
