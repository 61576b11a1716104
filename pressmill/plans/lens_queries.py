"""Lens queries over the stored tables, with SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions.text import STOPWORDS
from pressmill.operators import lens
from pressmill.sources.archive import ARTICLES_SQL, DECLINING_SQL, SKEWED_SQL, articles, declining, skewed, table


def docs_of(spark, d, change=skewed):
    """The corpus of terms. Lenses read it several times, so it is kept (on disk where memory is short) until the session's
    cache is cleared."""
    arts = articles(table(spark, d, "documents"))
    return lens.corpus(change(arts) if change else arts).persist()


def once(spark, d):
    """The corpus for queries that read it a single time."""
    return lens.corpus(articles(table(spark, d, "documents")))


def rounded(df, places: int = 9):
    return df.select(*[F.round(f.name, places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


def changed(rising: bool):
    def run(spark, d):
        docs = docs_of(spark, d, skewed if rising else declining)
        return lens.changes(lens.counted(docs), rising).select("term", "n", F.round("share", 9).alias("share"), F.round("base", 9).alias("base"), F.round("lift", 6).alias("lift"), F.round(F.log10(F.greatest("p", F.lit(1e-300))), 4).alias("log_p"), F.round("delta", 9).alias("delta"), F.col("total").cast("bigint").alias("total"))

    return run


def signals_raw(spark, d):
    docs = docs_of(spark, d)
    return rounded(lens.weak_signals_raw(docs, lens.counted(docs)).select("term", F.col("total").cast("bigint").alias("total"), "n", F.when(F.col("growth") < 1e300, F.col("growth")).alias("growth"), "delta"))


def signals(spark, d):
    docs = docs_of(spark, d)
    return rounded(lens.weak_signals(docs, lens.counted(docs)).select("place", "term", "total", "n", "delta"))


QUERIES = {
    "term_df": lambda spark, d: lens.vocabulary(once(spark, d)).select("term", F.col("total").cast("bigint").alias("total")),
    "term_period": lambda spark, d: lens.term_period(once(spark, d)),
    "period_density": lambda spark, d: lens.period_density(once(spark, d)),
    "vocab_size": lambda spark, d: lens.vocabulary(once(spark, d)).agg(F.count("*").alias("terms"), F.sum("total").cast("bigint").alias("pairs")),
    "scale_factors": lambda spark, d: lens.corpus_health(docs_of(spark, d)).select("period", "factor"),
    "corpus_health": lambda spark, d: lens.corpus_health(docs_of(spark, d)),
    "lens_rising": changed(True),
    "lens_falling": changed(False),
    "lens_rising_top": lambda spark, d: rounded(lens.rising_top(docs_of(spark, d)).select("place", "term", "n", "delta")),
    "lens_falling_top": lambda spark, d: rounded(lens.rising_top(docs_of(spark, d, declining), rising=False).select("place", "term", "n", "delta")),
    "weak_signals_raw": signals_raw,
    "weak_signals": signals,
    "backtest": lambda spark, d: rounded(lens.backtest(docs_of(spark, d))),
}

_STOP = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"
# words of each phrase, folded; single words and neighbours that are no stopwords
_TERMS = r"""
phrases as (select id, period, generate_subscripts(p, 1) as k, unnest(p) as phrase from (select id, period, string_split_regex({text}, '[.;:!?¡¿()\[\]«»"\n]+') as p from source)),
words as (select id, period, [translate(lower(w), 'áéíóúüñ', 'aeiouun') for w in regexp_extract_all(phrase, '(?i)[a-záéíóúüñ]{{4,}}')] as ws from phrases),
pairs as (select id, period, ws, unnest(range(1, len(ws) + 1)) as i from words),
found as (
  select distinct id, period, term from (
    select id, period, ws[i] as term from pairs where not list_contains({stop}, ws[i])
    union all
    select id, period, ws[i] || ' ' || ws[i + 1] from pairs where i < len(ws) and not list_contains({stop}, ws[i]) and not list_contains({stop}, ws[i + 1])
  )
)"""


def sql(articles_sql: str, view: str, text: str) -> str:
    source = f"source as (select id, cast(year(published_date) as varchar) as period, title, body from {view} where kind <> 'portada' and published_date is not null and is_full)"
    terms = _TERMS.format(text="coalesce(title, '') || '. ' || coalesce(body, '')", stop=_STOP)
    return f"with {articles_sql}, {source}, {terms} {text}"


_SCALE = """
, vocab as (select term, count(*) as total from found group by term having count(*) >= 4),
periods as (select period, count(*) as docs, row_number() over (order by period) as i, count(*) over () as np from source group by period),
cells as (select v.term, v.total, p.period, p.i, p.np, p.docs, count(f.id) as n from vocab v cross join periods p left join found f on f.term = v.term and f.period = p.period group by all),
good as (select term from cells where total >= 40 group by term having min(n) > 0),
ratios as (select period, (n / docs) / exp(avg(ln(n / docs)) over (partition by term)) as r from cells where term in (select term from good)),
factors as (select p.period, case when (select count(*) from good) < 200 or np < 2 then 1.0 else greatest((select round(quantile_cont(r, 0.5), 9) from ratios where ratios.period = p.period), 1e-6) end as factor from periods p),
corrected as (select c.*, n / docs / factor as q, factor from cells c join factors using (period))
"""


def _changes(rising: bool) -> str:
    keep = "n >= 6 and now / base >= 1.6" if rising else "base_n >= 6 and now / base <= 1 / 1.6"
    ks = "range(n, docs + 1)" if rising else "range(0, n + 1)"
    delta = "now - base" if rising else "base - now"
    return (
        _SCALE
        + f""", based as (
  select term, total, max(n) filter (i = np) as n, max(n / docs) filter (i = np) as share, max(q) filter (i = np) as now, max(docs) filter (i = np) as docs, max(factor) filter (i = np) as factor,
    avg(q) filter (i < np and i >= np - 5) as base, avg(n) filter (i < np and i >= np - 5) as base_n, max(np) as np
  from corrected group by term, total having total >= 6
), tested as (select *, least(base * factor, 0.999) as e from based where base > 0 and np >= 4 and {keep}),
pmf as (select term, [lgamma(docs + 1) - case when k = 0 then 0 else lgamma(k + 1) end - case when docs = k then 0 else lgamma(docs - k + 1) end + k * ln(e) + (docs - k) * ln(1 - e) for k in {ks}] as l from tested),
tails as (select t.*, least(1.0, exp(list_max(l)) * list_sum([exp(x - list_max(l)) for x in l])) as p from tested t join pmf using (term))
select term, n, round(share, 9) as share, round(base, 9) as base, round(now / base, 6) as lift, round(log10(greatest(p, 1e-300)), 4) as log_p, round({delta}, 9) as delta, total
from tails where p <= 0.01 / (select greatest(count(*), 1) from vocab where total >= 6)"""
    )


def _top(rows: str, columns: str) -> str:
    """The first 12 of 80 candidates, none of whose documents are mostly those of one before: a fold in order."""
    return f""", best as ({rows}), spec as (select b.term, max(coalesce(v.total, 0)) as common from (select term, unnest(string_split(term, ' ')) as word from best) b left join vocab v on v.term = b.word group by b.term),
cand as (select b.*, row_number() over (order by round(delta, 9) desc, contains(term, ' ') desc, common, term) as k from best b join spec using (term) qualify k <= 80),
held as (select k, id from cand join found using (term)), sizes as (select k, count(*) as n from held group by k),
near as (select a.k, list(b.k) as others from (select a.k as k, b.k as o, count(*) as n from held a join held b on a.id = b.id and b.k < a.k group by all) p, sizes a, sizes b where a.k = p.k and b.k = p.o and p.n / least(a.n, b.n) >= 0.8 group by a.k),
fold(k, kept) as (select cast(0 as bigint), cast([] as bigint[]) union all select c.k, case when len(kept) < 12 and not list_has_any(kept, coalesce(n.others, cast([] as bigint[]))) then list_append(kept, c.k) else kept end from fold f join cand c on c.k = f.k + 1 left join near n on n.k = c.k),
final as (select kept from fold order by k desc limit 1)
select list_position(kept, k) as place, {columns} from cand, final where list_contains(kept, k)"""


SQL = {
    "term_df": sql(ARTICLES_SQL, "articles", "select term, count(*) as total from found group by term having count(*) >= 4"),
    "term_period": sql(ARTICLES_SQL, "articles", "select term, period, count(*) as n from found where term in (select term from found group by term having count(*) >= 4) group by all"),
    "period_density": sql(ARTICLES_SQL, "articles", "select s.period, count(distinct s.id) as docs, round(count(f.term) / count(distinct s.id), 6) as density from source s left join found f using (id) group by s.period"),
    "vocab_size": sql(ARTICLES_SQL, "articles", "select count(*) as terms, cast(sum(n) as bigint) as pairs from (select count(*) as n from found group by term having count(*) >= 4)"),
    "scale_factors": sql(SKEWED_SQL, "skewed", _SCALE + "select period, round(factor, 6) as factor from factors"),
    "corpus_health": sql(SKEWED_SQL, "skewed", _SCALE + "select p.period, p.docs, round((select count(*) from found f where f.period = p.period) / p.docs, 6) as density, round(factor, 6) as factor, factor < 0.7 or factor > 1.4 as warning from periods p join factors using (period)"),
    "lens_rising": sql(SKEWED_SQL, "skewed", _changes(True)),
    "lens_falling": sql(DECLINING_SQL, "skewed", _changes(False)),
    "lens_rising_top": sql(SKEWED_SQL, "skewed", _changes(True).replace("select term, n, round(share", ", raw as (select *, now - base as delta from tails where p <= 0.01 / (select greatest(count(*), 1) from vocab where total >= 6)), unused as (select term, n, round(share") + ")" + _top("select term, n, delta from raw", "term, n, round(delta, 9) as delta")).replace("with ", "with recursive ", 1),
    "lens_falling_top": sql(DECLINING_SQL, "skewed", _changes(False).replace("select term, n, round(share", ", raw as (select *, base - now as delta from tails where p <= 0.01 / (select greatest(count(*), 1) from vocab where total >= 6)), unused as (select term, n, round(share") + ")" + _top("select term, n, delta from raw", "term, n, round(delta, 9) as delta")).replace("with ", "with recursive ", 1),
    "weak_signals_raw": sql(
        SKEWED_SQL,
        "skewed",
        _SCALE
        + """, titled as (
  select distinct term from (
    select unnest(list_concat([w for w in ws if not list_contains({stop}, w)], [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws)) if not list_contains({stop}, ws[i]) and not list_contains({stop}, ws[i + 1])])) as term
    from (select [translate(lower(w), 'áéíóúüñ', 'aeiouun') for w in regexp_extract_all(phrase, '(?i)[a-záéíóúüñ]{{4,}}')] as ws from (select unnest(string_split_regex(coalesce(title, ''), '[.;:!?¡¿()\\[\\]«»"\\n]+')) as phrase from source))
  )
), s as (
  select term, total, max(np) as np, max(n) filter (i = np) as n, max(q) filter (i = np - 3) as q1, max(q) filter (i = np - 2) as q2, max(q) filter (i = np - 1) as q3, max(q) filter (i = np) as q4
  from corrected group by term, total
)
select term, total, n, case when q1 > 0 then round(q4 / greatest(q1, 1e-9), 9) end as growth, round(q4 - q1, 9) as delta from s
where np >= 5 and total between 5 and 70 and q4 > 0 and cast(q2 >= q1 as int) + cast(q3 >= q2 as int) + cast(q4 >= q3 as int) >= 2 and (q1 = 0 or q4 / greatest(q1, 1e-9) >= 2) and term not in (select term from titled)""".format(stop=_STOP),
    ),
}
SQL["weak_signals"] = SQL["weak_signals_raw"].replace("with ", "with recursive ", 1).replace("select term, total, n, case when q1 > 0", ", raw as (select term, total, n, q4 - q1 as delta, case when q1 > 0", 1).replace(", round(q4 - q1, 9) as delta from s", " from s") + ")" + _top("select term, total, n, delta from raw", "term, total, n, round(delta, 9) as delta")
