"""Report queries over the stored tables, with SQL for each."""

from __future__ import annotations

from pressmill.operators import reports as r
from pressmill.sources.archive import ARTICLES_SQL, articles, table

WORDS = ["from", "that", "this"]
MARKERS = ["que", "mente", "ción"]
YEAR = 2017
GENERIC = dict(exact=("home", "index"), prefixes=("the and attion",), pattern=r"(?:weekly )?n[uú]mero\s*\d+")


def on_articles(f, *args, **kwargs):
    return lambda spark, d: f(articles(table(spark, d, "documents")), *args, **kwargs)


QUERIES = {
    "trend_quarterly": on_articles(r.trend_quarterly, "from"),
    "trend_yearly": on_articles(r.trend_yearly, "from"),
    "trend_year_grid": on_articles(r.trend_year_grid, WORDS),
    "pub_summary": on_articles(r.pub_summary),
    "inventory_totals": on_articles(r.inventory_totals),
    "metadata_coverage": on_articles(r.metadata_coverage),
    "year_by_publication": on_articles(r.year_by_publication),
    "length_percentiles": on_articles(r.length_percentiles, YEAR),
    "size_by_epoch_form": on_articles(r.size_by_epoch_form, YEAR),
    "closing_punctuation": on_articles(r.closing_punctuation),
    "pieces_per_issue": on_articles(r.pieces_per_issue),
    "repeated_titles": on_articles(r.repeated_titles),
    "short_bodies": on_articles(r.short_bodies),
    "generic_titles": on_articles(r.generic_titles, **GENERIC),
    "top_tags_year": on_articles(r.top_tags_year),
    "top_authors": on_articles(r.top_authors),
    "new_authors": on_articles(r.new_authors, 2014),
    "signed_docs": on_articles(r.signed_docs),
    "marker_prevalence": on_articles(r.marker_prevalence, MARKERS),
    "mean_words": on_articles(r.mean_words),
}

_WORDS = "string_split_regex(lower(coalesce(body, '')), '[^a-z]+')"
_FORM = "case when contains(url, '/articulo-completo/') then 'complete' else 'plain' end"
_EPOCH = f"case when year(published_date) >= {YEAR} then 'new' else 'old' end"
_SIZE = "case when length(body) < 3000 then 'short' else 'long' end"
_END = "rtrim(body, ' ' || chr(9) || chr(13) || chr(10))"


def sql(text: str) -> str:
    return f"with {ARTICLES_SQL} {text}"


def _pct(part: str) -> str:
    return f"cast({part} * 100 // greatest(count(*), 1) as bigint)"


_FOLD = "translate(lower({}), 'áéíóúüñ', 'aeiouun')"

SQL = {
    "trend_quarterly": sql(f"select cast(date_trunc('quarter', published_date) as date) as quarter, pub_slug, count(*) as n from pieces where published_date is not null and list_contains({_WORDS}, 'from') group by all"),
    "trend_yearly": sql(f"select year(published_date) as year, count(*) as n from pieces where published_date is not null and list_contains({_WORDS}, 'from') group by all"),
    "trend_year_grid": sql(f"""
, w as (select year(published_date) as year, {_WORDS} as found from pieces where published_date is not null),
years as (select unnest(range(min(year), max(year) + 1)) as year from w), words as (select unnest({WORDS}) as word)
select y.year, x.word, (select count(*) from w where w.year = y.year and list_contains(found, x.word)) as n from years y cross join words x"""),
    "pub_summary": sql("select pub_slug, count(*) as n, count(distinct issue_id) as issues, min(published_date) as first_date, max(published_date) as last_date, cast(sum(length(body)) as bigint) as chars, cast(round(sum(length(body)) / count(*)) as bigint) as mean_chars from pieces group by all"),
    "inventory_totals": sql("select count(*) as records, count(*) filter (kind <> 'portada') as pieces, count(*) filter (kind <> 'portada' and is_full) as \"full\", count(*) filter (kind <> 'portada' and not is_full) as partial, count(*) filter (published_date is null) as undated, count(*) filter (issue_id is null) as unissued, count(distinct issue_id) as issues from articles"),
    "metadata_coverage": sql(f"select pub_slug, {_pct('count(subtitle)')} as subtitle_pct, {_pct('count(*) filter (len(authors) > 0)')} as authors_pct, {_pct('count(*) filter (len(tags) > 0)')} as tags_pct, {_pct('count(published_date)')} as dated_pct, {_pct('count(issue_id)')} as issue_pct from pieces group by all"),
    "year_by_publication": sql("select year(published_date) as year, count(*) filter (pub_slug = 'bimonthly') as bimonthly, count(*) filter (pub_slug = 'weekly') as weekly from pieces where published_date is not null group by all"),
    "length_percentiles": sql(f"select {_EPOCH} as epoch, {_FORM} as form, count(*) as n, " + ", ".join(f"cast(quantile_disc(length(body), {p}) as bigint) as {k}" for k, p in {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9}.items()) + ", coalesce(cast(quantile_disc(length(body), 0.5) filter (is_full) as bigint), 0) as full_p50 from pieces where published_date is not null group by all"),
    "size_by_epoch_form": sql(f"select {_EPOCH} as epoch, {_FORM} as form, {_SIZE} as size, count(*) as n from pieces where published_date is not null group by all"),
    "closing_punctuation": sql(f"select {_SIZE} as size, count(*) as n, count(*) filter (regexp_matches({_END}, '[.!?»\"”)]\\z')) as closed, count(*) filter (regexp_matches({_END}, '(\\.\\.\\.|…)\\z')) as ellipsis, count(*) filter (not regexp_matches({_END}, '[.!?»\"”)…]\\z')) as open from pieces group by all"),
    "pieces_per_issue": sql("select year(published_date) as year, pub_slug, count(*) as n, count(distinct issue_id) as issues, round(count(*) / count(distinct issue_id), 1) as ratio from pieces where published_date is not null and issue_id is not null group by all"),
    "repeated_titles": sql("select title, count(*) as n from pieces group by title having count(*) > 2 order by n desc, title limit 8"),
    "short_bodies": sql("select pub_slug, count(*) filter (coalesce(body, '') = '' or length(body) < 200) as short, count(*) filter (not (coalesce(body, '') = '' or length(body) < 200)) as rest, count(*) filter (url like 'http%') as with_url from pieces group by all"),
    "generic_titles": sql(r", p as (select id, title, lower(trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g'))) as plain from pieces) select id, title from p where plain = '' or plain in ('home', 'index') or starts_with(plain, 'the and attion') or regexp_full_match(plain, '(?:weekly )?n[uú]mero\s*\d+')"),
    "top_tags_year": sql(", d as (select year(published_date) as year, tags from pieces where published_date is not null), t as (select unnest(tags) as tag from d where year = (select max(year) from d)), c as (select tag, count(*) as n from t group by tag order by n desc, tag limit 7) select tag, n, cast(n * 100 // (select max(n) from c) as bigint) as share from c"),
    "top_authors": sql(", a as (select unnest(authors) as author from pieces) select author, count(*) as n from a group by author order by n desc, author limit 10"),
    "new_authors": sql(f", a as (select unnest(authors) as author, year(published_date) as year from pieces where published_date is not null) select author, count(*) as n from a where year = 2014 and author not in (select author from a where year < 2014 and author is not null) group by author"),
    "signed_docs": sql(", a as (select id, year(published_date) as year, unnest(case when len(authors) = 0 then [cast(null as varchar)] else authors end) as author from pieces where published_date is not null) select year, count(distinct id) as pieces, count(distinct id) filter (author is not null) as signed, count(distinct author) as authors from a group by year"),
    "marker_prevalence": sql(f", m as (select unnest({MARKERS}) as marker), d as (select year(published_date) as year, {_FOLD.format('body')} as plain from pieces where published_date is not null and is_full) select year, marker, count(*) as docs, count(*) filter (contains(plain, {_FOLD.format('marker')})) as n, {_pct(f'count(*) filter (contains(plain, {_FOLD.format("marker")}))')} as pct from d cross join m group by year, marker"),
    "mean_words": sql(r"select pub_slug, round(avg(len(string_split_regex(coalesce(body, ''), '\s+'))), 6) as mean_words from pieces group by all"),
}
