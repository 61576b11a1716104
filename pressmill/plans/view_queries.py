"""Search, views, pages and rescue over the stored tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions.stemmer import GU_VERBS, KIND, RESIDUAL, RESIDUAL_E, VERBS, stem
from pressmill.functions.text import spanish_date
from pressmill.operators import index, rescue, search, web
from pressmill.operators.reports import long
from pressmill.sources.archive import ARTICLES_SQL, articles, table
from pressmill.sources.store import shared_place


def arts(spark, d):
    return articles(table(spark, d, "documents"))


def found(spark, d):
    rows = search.filtered(arts(spark, d), "weekly", 2016)
    return rows.where(F.array_contains(F.split(F.lower("body"), "[^a-z]+"), "from"))


def group_consecutive(spark, d):
    return search.grouped_all(arts(spark, d)).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


def fragments(spark, d):
    docs = table(spark, d, "documents")
    lines = F.transform(F.split("text", "\n"), lambda t: F.struct(F.lit("cuerpo").alias("kind"), t.alias("text")))
    heads = F.array(F.struct(F.lit("antetitulo").alias("kind"), F.upper("lang").alias("text")), F.struct(F.lit("titular").alias("kind"), F.substring("text", 1, 40).alias("text")))
    return docs.select(F.col("doc_id").alias("doc"), F.posexplode(F.concat(heads, lines)).alias("seq", "f")).select("doc", "seq", "f.kind", "f.text")


def sections(spark, d):
    return rescue.sections(fragments(spark, d))


def twin_match(spark, d):
    s = sections(spark, d).withColumn("issue_id", F.when(F.col("doc") % 11 != 0, F.floor(F.col("doc") / 5).cast("bigint"))).where("issue_id is not null")
    return rescue.twins(s, arts(spark, d))


def issue_texts(spark, d):
    rows = arts(spark, d).where("issue_id is not null")
    parts = F.array_sort(F.collect_list(F.struct("id", F.concat_ws("\n", "title", "body").alias("t"))))
    return rows.groupBy("issue_id").agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n").alias("text"))


def pdf_split(spark, d):
    return rescue.split_issue(issue_texts(spark, d), arts(spark, d).where("issue_id is not null")).select("issue_id", "id", "start", "chars")


def pdf_ratio(spark, d):
    web_chars = arts(spark, d).where("issue_id is not null and is_full").groupBy("issue_id").agg(long(F.sum(F.length("body"))).alias("web_chars"))
    return rescue.length_ratio(web_chars, issue_texts(spark, d).select("issue_id", long(F.length("text")).alias("pdf_chars")))


RANKED = '"of and" from -clown or por'
EXCLUDED = "-from -and or clown -eine"
VIEWED = "eine clown or from with"


def stored_index(spark, d, steps: bool = False) -> index.Index:
    """An index of the articles in the shared folder. With ``steps``: first a third of them, in which every other has another
    text; then all but a tenth, so that half of the first are replaced; then the rest, and some taken away."""
    found = index.Index(spark, shared_place(spark, "index"))
    rows = arts(spark, d)
    if not steps:
        found.add(rows)
        return found
    other = F.when(F.col("id") % 2 == 0, F.col("body")).otherwise(F.lit("from clown eine por"))
    found.add(rows.where("id % 3 = 0").withColumn("body", other))
    found.add(rows.where("id % 10 <> 0 and not (id % 3 = 0 and id % 2 = 0)"))
    found.add(rows.where("id % 10 = 0 and id % 6 <> 0"))
    found.remove(rows.where("id % 13 = 0").select("id"))
    return found


def ranked(spark, d):
    return search.ranked(stored_index(spark, d).postings(search.query_stems(RANKED)), RANKED)


def excluded(spark, d):
    found = stored_index(spark, d)
    return search.ranked(found.postings(search.query_stems(EXCLUDED)), EXCLUDED, found.pieces())


def added(spark, d):
    return stored_index(spark, d, True).hits(VIEWED, since=2015).select("id", "title", "rank")


def search_view(spark, d):
    return stored_index(spark, d).view(arts(spark, d), VIEWED, number=2, size=20, pub="weekly", since=2015)


def headlines(spark, d):
    stems = search.query_stems("eine from")
    return search.pieces(arts(spark, d)).select("id", search.snippet(F.col("body"), stems).alias("snippet"))


def spanish_dates(spark, d):
    months = F.array(*map(F.lit, web.MONTHS))
    date = F.col("published_date")
    text = F.concat(F.lit("Madrid, "), F.dayofmonth(date).cast("string"), F.lit(" de "), F.element_at(months, F.month(date)), F.lit(" de "), F.year(date).cast("string"), F.lit("."))
    return arts(spark, d).where("published_date is not null").select("id", spanish_date(text).alias("date"))


def html_links(spark, d):
    return web.same_site_links(table(spark, d, "pages")).select("page_id", F.array_join("links", " ").alias("links"))


def html_articles(spark, d):
    return web.article_records(table(spark, d, "pages")).select("page_id", "url", "kind", "title", "subtitle", F.array_join("authors", "|").alias("authors"), "published_date", "body", "is_full")


QUERIES = {
    "search_filtered": lambda spark, d: found(spark, d).select("id", "title", search.lead(found(spark, d), 420).alias("lead")),
    "search_page": lambda spark, d: search.page(found(spark, d), 2, 10).select("id", "published_date"),
    "search_page_count": lambda spark, d: search.page_count(found(spark, d)),
    "search_ranked": ranked,
    "search_view": search_view,
    "search_excluded": excluded,
    "search_added": added,
    "headlines": headlines,
    "group_consecutive": group_consecutive,
    "prev_next": lambda spark, d: search.neighbours(arts(spark, d)),
    "siblings": lambda spark, d: search.siblings(arts(spark, d)),
    "latest_issues": lambda spark, d: search.latest_issues(arts(spark, d)),
    "front_page": lambda spark, d: search.front_page(arts(spark, d)),
    "common_context": lambda spark, d: search.context(arts(spark, d)),
    "publication_years": lambda spark, d: search.pieces(arts(spark, d)).where("published_date is not null").select(long(F.year("published_date")).alias("year")).distinct(),
    "sections": sections,
    "twin_match": twin_match,
    "pdf_split": pdf_split,
    "pdf_ratio": pdf_ratio,
    "url_normalise": lambda spark, d: table(spark, d, "pages").select("page_id", web.normalised_url(F.col("url")).alias("url")),
    "spanish_dates": spanish_dates,
    "html_links": html_links,
    "html_articles": html_articles,
}

_FOUND = "found as (select * from pieces where pub_slug = 'weekly' and year(published_date) = 2016 and list_contains(string_split_regex(lower(body), '[^a-z]+'), 'from'))"
_NORMAL = "regexp_extract(regexp_replace({u}, '[?#].*$', ''), '^(https?://[^/]*)', 1) || regexp_replace(regexp_replace(regexp_replace({u}, '[?#].*$', ''), '^https?://[^/]*', ''), '/{{2,}}', '/', 'g')"
_SECTIONS = r"""sections as (
  select doc_id as doc, cast(1 as bigint) as place, upper(lang) as kicker,
    regexp_replace(regexp_replace(substr(text, 1, 40), '[ \t\x{A0}]+', ' ', 'g'), '^\s+|\s+$', '', 'g') as title,
    regexp_replace(regexp_replace(replace(text, chr(10), ''), '[ \t\x{A0}]+', ' ', 'g'), '^\s+|\s+$', '', 'g') as body
  from documents)"""
def _forms(word: str) -> str:
    """A pattern of a word's forms: all endings that the stemmer takes off and that leave the word's stem."""
    endings = {"", *KIND, *VERBS, *GU_VERBS, *RESIDUAL, *RESIDUAL_E}
    root = stem(word)
    return "|".join(sorted({w for base in {word, root} for e in endings if stem(w := base + e) == root}))


_FORMS = {word: f"(?:{_forms(word)})" for word in ("of", "and", "from", "clown", "por", "with", "eine")}
_WORDS = r"""words as (select *, [list_transform(regexp_extract_all(lower(coalesce(f, '')), '[\p{L}\p{N}_]+'), lambda w: ' ' || w || ' ') for f in [title, subtitle, body]] as fields from pieces)"""


def _has(word: str) -> str:
    return f"list_bool_or([len(list_filter(f, lambda w: regexp_matches(w, '^ {_FORMS[word]} $'))) > 0 for f in fields])"


def _rank(words: list[str]) -> str:
    parts = [f"list_sum([case when n > 0 then {weight} * (1 - 1 / (1 + log2(1 + n))) else 0 end for n in [len(list_filter(fields[{k}], lambda w: regexp_matches(w, '^ {_FORMS[word]} $')))]])" for word in words for k, weight in enumerate((1.0, 0.4, 0.2), 1)]
    return f"round({' + '.join(parts)}, 9)"


_VIEWED = f"hits as (select id, pub_slug, issue_id, published_date, title, body, {_rank(['clown', 'eine', 'from', 'with'])} as rank from words where {_has('eine')} and {_has('clown')} or {_has('from')} and {_has('with')})"


def _headlines(rows: str, words: list[str]) -> str:
    """(id, snippet) of rows with id and body: of the stretches that begin at a hit the one with most hits, and the next best
    that isn't over it."""
    forms = "|".join(_FORMS[w] for w in words)
    return rf"""split as (select id, list_filter(regexp_split_to_array(body, '\s+'), lambda w: w <> '') as ws from {rows}),
 marked as (select id, ws, list_transform(ws, lambda w: list_bool_or([regexp_matches(x, '^({forms})$') for x in regexp_extract_all(lower(w), '[\p{{L}}\p{{N}}_]+')]) is true) as m from split),
 places as (select id, ws, m, list_filter([case when y then i end for y, i in m], lambda i: i is not null) as hits from marked),
 starts as (select id, len(ws) as n, hits, unnest(hits) as s from places),
 ends as (select id, s, n, list_filter(hits, lambda h: h >= s and h < s + 30) as inside from starts),
 spans as (select id, s, len(inside) as k, least(n, greatest(list_max(inside), s + 14)) as e from ends),
 best as (select * from spans qualify row_number() over (partition by id order by k desc, s) = 1),
 next as (select spans.* from spans join best using (id) where spans.e < best.s or best.e < spans.s qualify row_number() over (partition by spans.id order by spans.k desc, spans.s) = 1),
 chosen as (select id, s, e from best union all select id, s, e from next union all select id, 1, least(15, len(ws)) from places where len(hits) = 0),
 written as (select id, s, array_to_string([case when m[i] then '<mark>' || ws[i] || '</mark>' else ws[i] end for i in range(s, e + 1)], ' ') as t from chosen join places using (id)),
 snippets as (select id, string_agg(t, ' … ' order by s) as snippet from written group by id)"""


_FOLD = "'áàäâéèëêíìïîóòöôúùüûñç', 'aaaaeeeeiiiioooouuuunc'"
_LETTERS = r"regexp_replace(strip_accents(lower({})), '[^\p{{L}}\p{{N}}]+', '', 'g')"
_MARK = "substr(regexp_replace(translate(lower({}), 'áàäâéèëêíìïîóòöôúùüûñç', 'aaaaeeeeiiiioooouuuunc'), '[^a-z0-9]+', '', 'g'), 1, 90)"

SQL = {
    "search_filtered": f"with {ARTICLES_SQL}, {_FOUND} select id, title, coalesce(subtitle, substr(body, 1, 420)) as lead from found",
    "search_page": f"with {ARTICLES_SQL}, {_FOUND} select id, published_date from found order by published_date desc nulls last, id desc limit 10 offset 10",
    "search_page_count": f"with {ARTICLES_SQL}, {_FOUND} select count(*) as total, cast(greatest(1, ceil(count(*) / 25)) as bigint) as pages from found",
    "group_consecutive": f"""with {ARTICLES_SQL}, p as (select *, row_number() over (order by published_date desc nulls last, id desc) as pos from pieces),
 f as (select *, coalesce(issue_id is not null and lag(issue_id) over (order by pos) = issue_id and lag(pub_slug) over (order by pos) = pub_slug, false) as same from p),
 g as (select *, sum(case when same then 0 else 1 end) over (order by pos) as island from f)
 select cast(island as bigint) as island, arg_min(pub_slug, pos) as pub_slug, min(issue_id) as issue_id, first(published_date order by pos) as published_date, string_agg(cast(id as varchar), ',' order by pos) as ids from g group by island""",
    "prev_next": f"with {ARTICLES_SQL} select id, lag(id) over w as previous_id, lead(id) over w as next_id from pieces where published_date is not null window w as (partition by pub_slug order by published_date, id)",
    "search_ranked": f"""with {ARTICLES_SQL}, {_WORDS} select id, {_rank(['and', 'from', 'of', 'por'])} as rank from words
 where list_bool_or([contains(array_to_string(f, ''), ' of  and ') for f in fields]) and {_has('from')} and not {_has('clown')} or {_has('por')}""",
    "search_excluded": f"with {ARTICLES_SQL}, {_WORDS} select id, {_rank(['clown'])} as rank from words where not {_has('from')} and not {_has('and')} or {_has('clown')} and not {_has('eine')}",
    "search_added": f"""with {ARTICLES_SQL.replace("where kind <> 'portada'", "where kind <> 'portada' and id % 13 <> 0")}, {_WORDS}, {_VIEWED} select id, title, rank from hits where year(published_date) >= 2015""",
    "search_view": f"""with {ARTICLES_SQL}, {_WORDS}, {_VIEWED},
 page as (select row_number() over (order by rank desc, published_date desc nulls last, id desc) as pos, * from hits where pub_slug = 'weekly' and year(published_date) >= 2015 order by pos limit 20 offset 20),
 again as (select cast(pos - 20 as int) as pos, * exclude (pos) from page),
 same as (select *, coalesce(issue_id is not null and lag(issue_id) over (order by pos) = issue_id and lag(pub_slug) over (order by pos) = pub_slug, false) as follows from again),
 {_headlines('again', ['clown', 'eine', 'from', 'with'])}
 select pos, cast(sum(case when follows then 0 else 1 end) over (order by pos) as bigint) as island, id, pub_slug, issue_id, published_date, title, rank, snippet from same join snippets using (id)""",
    "headlines": f"with {ARTICLES_SQL}, {_headlines('pieces', ['eine', 'from'])} select pieces.id, case when body is not null then coalesce(snippet, '') end as snippet from pieces left join snippets using (id)",
    "siblings": f"with {ARTICLES_SQL} select a.id, b.id as sibling_id from pieces a join pieces b on a.issue_id = b.issue_id and a.pub_slug = b.pub_slug and a.id <> b.id",
    "latest_issues": f"with {ARTICLES_SQL}, t as (select issue_id, max(published_date) as published_date, count(*) as pieces from pieces where issue_id is not null and published_date is not null group by issue_id order by 2 desc, 1 desc limit 3) select row_number() over (order by published_date desc, issue_id desc) as place, issue_id, published_date, pieces from t",
    "front_page": f"with {ARTICLES_SQL}, t as (select issue_id from pieces where issue_id is not null and published_date is not null group by issue_id order by max(published_date) desc, issue_id desc limit 1) select id, row_number() over (order by length(body) desc nulls last, id) = 1 as feature, coalesce(subtitle, substr(body, 1, 420)) as lead, length(body) as chars from pieces where issue_id = (select issue_id from t)",
    "common_context": f"with {ARTICLES_SQL} select count(*) as pieces, count(distinct issue_id) as issues, min(published_date) as first_date, max(published_date) as last_date from pieces",
    "publication_years": f"with {ARTICLES_SQL} select distinct year(published_date) as year from pieces where published_date is not null",
    "sections": f"with {_SECTIONS} select * from sections where length(body) >= 600",
    "twin_match": f"with {ARTICLES_SQL}, {_SECTIONS}, s as (select doc, doc // 5 as issue_id, place, {_MARK.format('body')} as mark from sections where doc % 11 <> 0 and length(body) >= 600), a as (select issue_id, id, {_MARK.format('body')} as mark from articles where issue_id is not null) select doc, s.issue_id, place, a.id from s join a using (issue_id, mark) where length(mark) = 90 qualify count(*) over (partition by doc, place) = 1",
    "pdf_split": f"""with {ARTICLES_SQL}, t as (select issue_id, string_agg(title || chr(10) || body, chr(10) order by id) as text from articles where issue_id is not null group by issue_id),
 g as (select issue_id, text, list_filter(list_transform(string_split(text, ''), lambda x, i: case when regexp_matches(x, '[\\p{{L}}\\p{{N}}]') then i end), lambda i: i is not null) as places, {_LETTERS.format('text')} as plain from t),
 a as (select issue_id, id, {_LETTERS.format('title')} as mark, count(*) over (partition by issue_id) = 1 as alone from articles where issue_id is not null),
 l as (select a.*, g.text, g.places, case when length(mark) >= 10 then coalesce(nullif(instr(plain, mark), 0), case when length(mark) >= 40 then nullif(instr(plain, substr(mark, 1, 40)), 0) end, case when length(mark) >= 30 then nullif(instr(plain, substr(mark, 1, 30)), 0) end, case when length(mark) >= 22 then nullif(instr(plain, substr(mark, 1, 22)), 0) end) end as spot from a join g using (issue_id)),
 s as (select issue_id, id, text, case when alone then 0 else places[spot] - 1 end as start from l where alone or spot is not null),
 e as (select *, coalesce(lead(start) over (partition by issue_id order by start, id), length(text)) as stop from s)
 select issue_id, id, cast(start as bigint) as start, length(regexp_replace(substr(text, start + 1, stop - start), '^\\s+|\\s+$', '', 'g')) as chars from e""",
    "pdf_ratio": f"with {ARTICLES_SQL}, w as (select issue_id, cast(sum(length(body)) filter (is_full) as bigint) as web_chars, cast(sum(length(title) + length(body) + 2) - 1 as bigint) as pdf_chars from articles where issue_id is not null group by issue_id), r as (select *, pdf_chars / greatest(web_chars, 1) as ratio from w where web_chars is not null) select issue_id, web_chars, pdf_chars, round(ratio, 6) as ratio, case when ratio < 1.6 then 'same' when ratio < 2.5 then 'some missing' else 'much missing' end as verdict from r",
    "url_normalise": f"select page_id, {_NORMAL.format(u='url')} as url from pages",
    "spanish_dates": f"with {ARTICLES_SQL} select id, strftime(published_date, '%Y-%m-%d') as date from articles where published_date is not null",
    "html_links": """with l as (select page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) as root, regexp_extract_all(html, '<a href="(/[^"]*)"', 1) as hrefs from pages),
 u as (select page_id, root, unnest(hrefs) as href, generate_subscripts(hrefs, 1) as i from l),
 f as (select page_id, root || regexp_replace(regexp_replace(replace(href, '&amp;', '&'), '[?#].*$', ''), '/{2,}', '/', 'g') as link, min(i) as i from u group by all)
 select page_id, string_agg(link, ' ' order by i) as links from f group by page_id""",
}
