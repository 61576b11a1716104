"""Stored pages to article records, links and dates. Markup is read by one Arrow function; all rules on what it finds, such
as which title counts, are column expressions."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.addresses import host, parts, plain_address, resolved
from pressmill.functions.text import collapse, spanish_date
from pressmill.operators.model import slug_words
from pressmill.operators.reports import is_generic_title
from pressmill.sources.archive import html_key

BLOCKS = ("p", "h2", "h3", "blockquote", "li")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Places a body may be in, in this order, the longest text wins; links to the next page, to a file, and where
# an issue has its date.
BODIES = "div.entry-content", "div.post-content", "div.article-content", "section.article-body", "article .content", "article", "main"
NEXT, FILE, DATED = "a.next, .nav-links a.next, a[rel=next]", "a[href*='download.php']", ".ctaSubscriptionsTitle"
# Elements and classes whose text is no part of a body, phrases of a page that is cut off.
JUNK_TAGS = frozenset("script style nav form aside footer header".split())
JUNK_CLASSES = frozenset("related share social newsletter paywall".split())
PAYWALL = ("suscríbete para seguir leyendo", "contenido exclusivo para suscriptores", "para seguir leyendo", "inicia sesión para continuar", "hazte suscriptor")
LEAST_FULL = 1200
ARTICLE_TYPES = ("Article", "NewsArticle", "BlogPosting")

RECORD = (
    "headings array<string>, title string, metas map<string,string>, repeated_metas array<string>, ld string, time string, "
    "anchors array<struct<href:string,rel:string,text:string>>, next string, canonical string, body string, plain string, "
    "seconds array<string>, dated string, file string"
)

COMPOUND = re.compile(r"""([\w-]+|\*)?((?:\.[\w-]+|\[[\w-]+(?:[*^$~]?=(?:'[^']*'|"[^"]*"|[^\]'"]*))?\])*)""")
CONDITION = re.compile(r"""\.([\w-]+)|\[([\w-]+)(?:([*^$~]?=)(?:'([^']*)'|"([^"]*)"|([^\]'"]*)))?\]""")
TESTS = {
    "=": lambda has, wanted: has == wanted,
    "*=": lambda has, wanted: wanted != "" and wanted in has,
    "^=": lambda has, wanted: wanted != "" and has.startswith(wanted),
    "$=": lambda has, wanted: wanted != "" and has.endswith(wanted),
    "~=": lambda has, wanted: wanted in has.split(),
}


#: Selectors that have been read.
_read: dict[str, list] = {}


def selector(text: str) -> list[list[tuple]]:
    """Alternatives, each a chain from an ancestor down of (tag or None, classes, attribute conditions)."""
    if text in _read:
        return _read[text]
    found = []
    for alternative in text.split(","):
        chain = []
        for compound in alternative.split():
            m = COMPOUND.fullmatch(compound)
            if not m:
                raise ValueError(f"not a selector: {text}")
            conditions = CONDITION.findall(m[2])
            classes = {c[0] for c in conditions if c[0]}
            chain.append((m[1] if m[1] != "*" else None, classes, [(c[1], c[2], c[3] or c[4] or c[5]) for c in conditions if c[1]]))
        found.append(chain)
    _read[text] = found
    return found


def fits(node: list, compound: tuple) -> bool:
    tag, classes, attributes = compound
    if tag and node[0] != tag or not classes <= set(node[1].get("class", "").split()):
        return False
    return all(name in node[1] and (not op or TESTS[op](node[1][name], wanted)) for name, op, wanted in attributes)


def selected(nodes: list[list], i: int, text: str) -> bool:
    """Whether node i is what a selector names; of each chain the nearest fitting ancestors are taken."""
    for chain in selector(text):
        if fits(nodes[i], chain[-1]):
            left, at = len(chain) - 1, nodes[i][2]
            while left and at > 0:
                left -= fits(nodes[at], chain[left - 1])
                at = nodes[at][2]
            if not left:
                return True
    return False


class Reader(HTMLParser):
    """Elements as (tag, attributes, parent, first part, end part) over the list of the page's texts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = [["", {}, -1, 0, None]]
        self.stack, self.parts, self.owner = [0], [], []

    def handle_starttag(self, tag, attrs):
        if tag == "p" and any(self.nodes[n][0] == "p" for n in self.stack):
            self.handle_endtag("p")
        self.nodes.append([tag, {k: v or "" for k, v in attrs}, self.stack[-1], len(self.parts), None])
        if tag in VOID:
            self.nodes[-1][4] = len(self.parts)
        else:
            self.stack.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.nodes[self.stack[k]][0] == tag:
                for n in self.stack[k:]:
                    self.nodes[n][4] = len(self.parts)
                del self.stack[k:]
                return

    def handle_data(self, data):
        self.parts.append(data)
        self.owner.append(self.stack[-1])

    def close(self):
        super().close()
        for n in self.nodes:
            n[4] = len(self.parts) if n[4] is None else n[4]


def article_object(values: list) -> dict:
    """The first article in linked data, also inside a graph; else the first object with a date."""
    flat, todo = [], list(values)
    while todo:
        v = todo.pop(0)
        if isinstance(v, list):
            todo = v + todo
        elif isinstance(v, dict):
            flat.append(v)
            if isinstance(v.get("@graph"), list):
                todo = v["@graph"] + todo
    kinds = lambda v: v.get("@type") if isinstance(v.get("@type"), list) else [v.get("@type")]
    return next((v for v in flat if set(kinds(v)) & set(ARTICLE_TYPES)), None) or next((v for v in flat if v.get("datePublished")), {})


def read_page(html: str) -> dict:
    r = Reader()
    r.feed(html or "")
    r.close()
    nodes, parts = r.nodes, r.parts
    junk = [False] * len(nodes)
    for i, (tag, attrs, parent, _, _) in enumerate(nodes):
        junk[i] = (parent >= 0 and junk[parent]) or tag in JUNK_TAGS or not JUNK_CLASSES.isdisjoint(attrs.get("class", "").split())
    squeeze = lambda s: " ".join(s.split())
    text = lambda n: squeeze(" ".join(parts[n[3] : n[4]]))
    clean = lambda a, b: squeeze(" ".join(parts[k] for k in range(a, b) if not junk[r.owner[k]]))

    def body_of(n: list) -> str:
        inside = [m for i, m in enumerate(nodes) if m[0] in BLOCKS and n[3] <= m[3] and m[4] <= n[4] and not junk[i] and m is not n]
        found = [t for m in inside if (t := clean(m[3], m[4]))]
        return "\n\n".join(found) or clean(n[3], n[4])

    body = ""
    named = lambda wanted: next((n for i, n in enumerate(nodes) if i and selected(nodes, i, wanted)), None)
    for wanted in BODIES:
        node = named(wanted)
        if node is not None and len(found := body_of(node)) > len(body):
            body = found
    metas, tags, linked = {}, [], []
    for n in nodes:
        if n[0] == "meta" and (name := n[1].get("property") or n[1].get("name")):
            metas.setdefault(name, n[1].get("content", ""))
            if name == "article:tag":
                tags.append(n[1].get("content", ""))
        elif n[0] == "script" and n[1].get("type") == "application/ld+json":
            try:
                linked.append(json.loads("".join(parts[n[3] : n[4]])))
            except ValueError:
                pass
    first = lambda tag, key=None, **wanted: next((n[1].get(key) if key else text(n) for n in nodes if n[0] == tag and all(n[1].get(k) == v for k, v in wanted.items())), None)
    link, file, dated = named(NEXT), named(FILE), named(DATED)
    return {
        "headings": [t for n in nodes if n[0] == "h1" and (t := text(n))],
        "title": first("title"),
        "metas": metas,
        "repeated_metas": tags,
        "ld": json.dumps(article_object(linked), ensure_ascii=False),
        "time": first("time", "datetime"),
        "anchors": [{"href": n[1].get("href", ""), "rel": n[1].get("rel", ""), "text": text(n)} for n in nodes if n[0] == "a"],
        "next": next((h for n in nodes if n[0] == "link" and "next" in n[1].get("rel", "").split() and (h := n[1].get("href"))), None) or (link and link[1].get("href") or None),
        "canonical": first("link", "href", rel="canonical"),
        "body": body,
        "plain": squeeze(" ".join(parts)),
        "seconds": [text(n) for n in nodes if n[0] == "h2"],
        "dated": dated and text(dated),
        "file": file and file[1]["href"],
    }


def page_parts(html: str) -> Column:
    return F.pandas_udf(_page_parts, RECORD)(html)


def _page_parts(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_page(h) for h in html], columns=[c.split()[0] for c in RECORD.split(", ")])


def normalised_url(url: Column) -> Column:
    return plain_address(url)


def same_site_links(pages: DataFrame, base: Column | None = None) -> DataFrame:
    """(page_id, links): addresses on the host of ``base``, the page's own address by default, in order, each once;
    links to places in the page itself are none."""
    base = F.col("url") if base is None else base
    rows = pages.select("page_id", base.alias("base"), page_parts("html").alias("p"))
    links = F.transform(F.filter("p.anchors", lambda a: (a["href"] != "") & ~a["href"].startswith("#")), lambda a: plain_address(resolved(a["href"], F.col("base"))))
    return rows.select("page_id", F.array_distinct(F.filter(links, lambda u: host(u) == host(F.col("base")))).alias("links"))


def next_pages(pages: DataFrame, base: Column | None = None, within: str = "/archivo/") -> DataFrame:
    """(page_id, next): the page that a list goes on with, if it is still in the archive."""
    base = F.col("url") if base is None else base
    rows = pages.select("page_id", base.alias("base"), page_parts("html").alias("p"))
    rows = rows.where("p.next is not null").select("page_id", resolved(F.col("p.next"), F.col("base")).alias("next"))
    return rows.where(F.col("next").contains(within))


def article_links(links: DataFrame, patterns: list[str], excluded: list[str]) -> DataFrame:
    """(page_id, link) of links that look like articles."""
    rows = links.select("page_id", F.explode("links").alias("link"))
    path = F.regexp_replace("link", r"^https?://[^/]*", "")
    rows = rows.where((path != "/") & (path != "") & path.rlike("|".join(patterns)))
    for prefix in excluded:
        rows = rows.where(~path.startswith(prefix))
    return rows


def issue_links(links: DataFrame, hint: str, slug: str) -> DataFrame:
    rows = links.select("page_id", F.explode("links").alias("link"))
    return rows.where((F.col("link").contains(hint) | F.col("link").rlike(rf"{slug}-\d+/?\z")) & ~F.col("link").rlike("/archivo/|/ultimo/"))


def article_records(pages: DataFrame, generic: tuple[str, ...] = (), prefixes: tuple[str, ...] = (), breadcrumb: str = r"(?!)", suffix: str = r"\s+\|\s+[^|]*\z") -> DataFrame:
    """One record per page: title, subtitle, authors, date, tags, body and whether it is all there. The first title that
    isn't generic counts: linked data, open graph, headings, title, address; a generic description is no subtitle."""
    rows = pages.select("page_id", "url", page_parts("html").alias("p")).withColumn("d", F.try_parse_json("p.ld"))
    ld = lambda path: F.try_variant_get("d", path, "string")
    meta = lambda name: F.col("p.metas")[name]
    titles = F.concat(F.array(ld("$.headline"), meta("og:title")), F.col("p.headings"), F.array(F.col("p.title"), F.col("url")))
    usable = F.filter(titles, lambda t: ~is_generic_title(t, generic, prefixes, breadcrumb))
    described = ~is_generic_title(meta("og:description"), generic, prefixes, breadcrumb)
    people = F.coalesce(F.try_variant_get("d", "$.author", "array<struct<name:string>>"), F.array(F.struct(ld("$.author.name").alias("name"))))
    named = F.filter(F.transform(people, lambda x: x["name"]), lambda x: x.isNotNull())
    linked = F.array_sort(F.array_distinct(F.transform(F.filter("p.anchors", lambda a: a["href"].contains("/autores/") & (a["text"] != "")), lambda a: a["text"])))
    tags = F.array_sort(F.array_distinct(F.transform(F.filter("p.anchors", lambda a: a["rel"] == "tag"), lambda a: a["text"])))
    date = F.coalesce(ld("$.datePublished"), meta("article:published_time"), F.col("p.time"), spanish_date(F.col("p.plain")))
    marked = F.lit(False)
    for m in PAYWALL:
        marked = marked | F.lower("p.body").contains(m)
    return rows.select(
        "page_id",
        normalised_url(F.col("url")).alias("url"),
        F.when(F.col("url").rlike(r"/articulo/(?:[a-z0-9-]*-)?(?:" + "|".join(MONTHS) + ")-?(?:" + "|".join(MONTHS) + r")-(?:19|20)\d{2}/?\z"), "portada").otherwise("articulo").alias("kind"),
        F.regexp_replace(collapse(F.get(usable, F.lit(0))), suffix, "").alias("title"),
        F.when(described, meta("og:description")).alias("subtitle"),
        F.when(F.size(named) > 0, named).otherwise(linked).alias("authors"),
        F.substring(date, 1, 10).alias("published_date"),
        F.when(F.size("p.repeated_metas") > 0, F.col("p.repeated_metas")).otherwise(tags).alias("tags"),
        F.col("p.body").alias("body"),
        ((F.length("p.body") >= LEAST_FULL) & ~marked).alias("is_full"),
    )


MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()


def issue_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, number, title, published_date, pdf_url) of issue pages: the number that ends the address; the first heading
    that isn't empty, with the number, else the address; the date of the subscription block, else of the page's data."""
    rows = pages.select("page_id", "url", page_parts("html").alias("p"))
    number = F.regexp_extract(parts(F.col("url"))["path"], r"-(\d+)/?\z", 1)
    heading = F.get("p.headings", F.lit(0))
    title = F.when(number != "", F.concat_ws(" ", heading, number.cast("int").cast("string"))).otherwise(heading)
    own = spanish_date(F.col("p.dated"))
    date = F.coalesce(own, F.nullif(F.substring(F.coalesce(F.col("p.metas")["article:published_time"], F.col("p.time")), 1, 10), F.lit("")))
    return rows.select("page_id", "url", F.when(number != "", number.cast("int")).alias("number"), F.when(heading.isNotNull(), title).otherwise(F.col("url")).alias("title"), date.alias("published_date"), resolved(F.col("p.file"), F.col("url")).alias("pdf_url"))


def assembled(records: DataFrame, publication: str, now: Column) -> DataFrame:
    """Parsed records (with issue_url, issue_date, and ``missing`` where the server had no page) as they are stored: the
    publication, a date from the issue where the page has none, the file's name, the time read, and a status. Nothing but
    the status is stored of a missing page."""
    there = ~F.col("missing")
    full = F.when(~there, "404").when(F.col("is_full"), "ok").otherwise("paywalled")
    kept = [F.when(there, F.col(c)).alias(c) for c in records.columns if c not in ("page_id", "url", "missing", "issue_date", "published_date")]
    date = F.when(there, F.coalesce("published_date", "issue_date"))
    return records.select("page_id", "url", *kept, date.alias("published_date"), F.when(there, F.lit(publication)).alias("publication"), F.when(there, html_key("url")).alias("raw_html_path"), F.when(there, now).alias("scraped_at"), full.alias("status"))


def diagnostics(pages: DataFrame) -> DataFrame:
    """What a page says of itself: title, open-graph title, canonical address, first and second headings, and how many of the
    words of its address are in it."""
    rows = pages.select("page_id", "url", "html", page_parts("html").alias("p"), slug_words(F.col("url")).alias("slug"))
    inside = F.size(F.filter("slug", lambda w: F.contains(F.lower("html"), F.lower(w))))
    short = lambda c, n: F.transform(F.slice(c, 1, n), lambda t: F.substring(t, 1, 80))
    return rows.select("page_id", "url", F.length("html").cast("bigint").alias("chars"), F.substring("p.title", 1, 90).alias("title"), F.substring(F.col("p.metas")["og:title"], 1, 90).alias("og_title"), F.substring("p.canonical", 1, 110).alias("canonical"), short("p.headings", 3).alias("h1"), short("p.seconds", 4).alias("h2"), "slug", inside.cast("bigint").alias("slug_found"))


def reparsed(old: DataFrame, fresh: DataFrame, only: Column | None = None) -> DataFrame:
    """Old records with title, subtitle, authors, tags, body and is_full read anew where ``only`` holds; a date that is no
    longer found stays."""
    redo = (F.lit(True) if only is None else only) & F.col("n.url").isNotNull()
    both = old.alias("o").join(fresh.alias("n"), F.col("o.url") == F.col("n.url"), "left")
    new = ("title", "subtitle", "authors", "tags", "body", "is_full")
    columns = [F.when(redo, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in new else F.when(redo, F.coalesce("n.published_date", "o.published_date")).otherwise(F.col("o.published_date")).alias(c) if c == "published_date" else F.col(f"o.{c}") for c in old.columns]
    return both.select(*columns)


def reparse_counts(old: DataFrame, fresh: DataFrame, generic: tuple[str, ...] = (), prefixes: tuple[str, ...] = (), breadcrumb: str = r"(?!)", only_generic: bool = False) -> DataFrame:
    """(articles, changed, without_html, still_generic) of reading old records anew: titles that came out otherwise, records
    whose page isn't stored, and titles that say nothing afterwards."""
    says_nothing = lambda c: is_generic_title(c, generic, prefixes, breadcrumb)
    both = old.select("url", F.col("title").alias("before")).join(fresh.select("url", F.col("title").alias("now"), F.lit(True).alias("stored")), "url", "left")
    redo = F.col("stored").isNotNull() & (says_nothing(F.col("before")) if only_generic else F.lit(True))
    after = F.when(redo, F.col("now")).otherwise(F.col("before"))
    count = lambda c: F.count_if(c).cast("bigint")
    return both.agg(F.count("*").cast("bigint").alias("articles"), count(redo & ~F.col("now").eqNullSafe(F.col("before"))).alias("changed"), count(F.col("stored").isNull()).alias("without_html"), count(says_nothing(after)).alias("still_generic"))
