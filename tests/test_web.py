"""Addresses, selectors, and what is read from pages of lists and issues."""

import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from pressmill.functions.addresses import host, plain_address, resolved
from pressmill.operators import web

BASE = "http://a/b/c/d;p?q"
# published examples of the rule
EXAMPLES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y",
    "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x",
    "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
    "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
    "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h",
    "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x", "g#s/../x": "http://a/b/c/g#s/../x",
}


def test_published_examples(spark):
    rows = spark.createDataFrame([(k,) for k in EXAMPLES], "ref string")
    assert {r["ref"]: r["at"] for r in rows.select("ref", resolved(F.col("ref"), F.lit(BASE)).alias("at")).collect()} == EXAMPLES


def test_other_bases(spark):
    cases = [(ref, base) for ref in ("x", "../x/./y", "//h2/p", "?n=2", " /s ", "mailto:a@b", "https://o/p/../q") for base in ("https://h", "https://h/", "https://h/a/b?c/d", "https://h:81/a/")]
    rows = spark.createDataFrame(cases, "ref string, base string").select("ref", "base", resolved(F.col("ref"), F.col("base")).alias("at"), plain_address(resolved(F.col("ref"), F.col("base"))).alias("plain"), host(F.col("base")).alias("host"))
    for r in rows.collect():
        want = urljoin(r["base"], r["ref"].strip())
        assert r["at"] == (want if "../q" not in r["ref"] else "https://o/q")
        assert r["plain"] == re.sub(r"[?#].*", "", r["at"]) and r["host"] == re.search("//([^/?]+)", r["base"])[1]
    nulls = spark.range(1).select(resolved(F.lit(None).cast("string"), F.lit(BASE)).alias("x")).first()
    assert nulls["x"] is None


HTML = """<html><body class=page><nav class="nav-links"><a class="prev" href=p>1</a><div><a class="next x" href=n>2</a></div></nav>
<article id=one><div class="content wide"><p>uno</p></div></article><div class=content><p>dos</p></div><a rel=next href=r>3</a><a href="/f/download.php?id=4">pdf</a></body></html>"""


@pytest.mark.parametrize(
    "text, want",
    [("article .content", ["content wide"]), (".content", ["content wide", "content"]), ("a.next", ["next x"]), (".nav-links a.next, a[rel=next]", ["next x", ""]), ("body div .content", []), ("body article p", [""]), ("a[href*='download.php']", [""]), ('a[href^="/f"]', [""]), ("a[class~=x]", ["next x"]), ("[class$=ide]", ["content wide"]), ("nav.nav-links.other a", []), ("* > p", None)],
)
def test_selectors(text, want):
    reader = web.Reader()
    reader.feed(HTML)
    reader.close()
    if want is None:
        with pytest.raises(ValueError):
            web.selector(text)
        return
    assert [n[1].get("class", "") for i, n in enumerate(reader.nodes) if i and web.selected(reader.nodes, i, text)] == want


def pages(spark, **html):
    return spark.createDataFrame([(k, f"https://h.example/{k}", v) for k, v in html.items()], "page_id string, url string, html string")


def test_body_of_a_content_block_inside_an_article(spark):
    long = "<p>" + "largo " * 20 + "</p>"
    rows = pages(spark, a=f"<article><h2>x</h2><div class='content'>{long}</div></article>", b=f"<div class='content'>{long}</div><main><p>corto</p></main>")
    assert {r["page_id"]: r["body"] for r in web.article_records(rows).collect()} == {"a": "x\n\n" + ("largo " * 20).strip(), "b": "corto"}


def test_next_pages(spark):
    rows = pages(
        spark, link="<link rel='prefetch next' href='/archivo/2020/page/2/'><a class=next href=/archivo/x>n</a>", anchor="<div class='nav-links'><a class='next page' href='archivo/../archivo/3'>n</a></div>", rel="<a rel=next href='?p=2'>n</a>",
        other="<a class=next href=/2023/page/2/>n</a>", none="<a href=/archivo/>n</a>", empty=None,
    )
    assert {r["page_id"]: r["next"] for r in web.next_pages(rows).collect()} == {"link": "https://h.example/archivo/2020/page/2/", "anchor": "https://h.example/archivo/3"}
    everywhere = {r["page_id"]: r["next"] for r in web.next_pages(rows, F.lit("https://o.example/l/m"), within="").collect()}
    assert everywhere["rel"] == "https://o.example/l/m?p=2" and everywhere["other"] == "https://o.example/2023/page/2/" and "none" not in everywhere


def test_links_against_another_base(spark):
    rows = pages(spark, a="<a href=x>1</a><a href='//h.example//y'>2</a><a href='https://o.example/z'>3</a><a href='mailto:m@h.example'>4</a><a href='x#f'>5</a><a href='../w?q'>6</a>")
    assert web.same_site_links(rows).first()["links"] == ["https://h.example/x", "https://h.example/y", "https://h.example/w"]
    assert web.same_site_links(rows, F.lit("https://o.example/")).first()["links"] == ["https://o.example/x", "https://o.example/z", "https://o.example/w"]


def test_issue_records(spark):
    full = "<h1 class=title_cat> </h1><h1>Informe  Semanal</h1><p>1 de enero de 1999</p><div class=ctaSubscriptionsTitle>Número del <b>3 de mayo</b> de 2021</div><a href='../f/download.php?x=1'>PDF</a>"
    rows = spark.createDataFrame(
        [("full", "https://h.example/n/informe-0147/", full), ("meta", "https://h.example/n/revista", "<meta property='article:published_time' content='2020-02-03T10:00'><h1>Revista</h1>"), ("time", "https://h.example/n/x-9", "<time datetime='2018-01-02'></time>"), ("none", "https://h.example/n/", None)],
        "page_id string, url string, html string",
    )
    got = {r["page_id"]: tuple(r)[2:] for r in web.issue_records(rows).collect()}
    assert got == {
        "full": (147, "Informe Semanal 147", "2021-05-03", "https://h.example/n/f/download.php?x=1"), "meta": (None, "Revista", "2020-02-03", None),
        "time": (9, "https://h.example/n/x-9", "2018-01-02", None), "none": (None, "https://h.example/n/", None, None),
    }


def test_issue_links(spark):
    rows = pages(spark, a="".join(f"<a href='{h}'>x</a>" for h in ("/revista-informe/5/", "/informe-12/", "/informe-12x/", "/archivo/informe-13/", "/ultimo/revista-informe/", "/otro")))
    assert [r["link"] for r in web.issue_links(web.same_site_links(rows), "/revista-informe/", "informe").collect()] == ["https://h.example/revista-informe/5/", "https://h.example/informe-12/"]


def test_diagnostics(spark):
    rows = spark.createDataFrame([(1, "https://h.example/a/la-guerra-larga-2020-energia-verde/", "<title>T</title><h1>U</h1><h2>D</h2><h2>E</h2><p>Guerra y ENERGIA</p>"), (2, "https://h.example/", None)], "page_id int, url string, html string")
    got = {r["page_id"]: r.asDict() for r in web.diagnostics(rows).collect()}
    assert got[1]["slug"] == ["guerra", "larga", "energia"] and got[1]["slug_found"] == 2 and got[1]["h2"] == ["D", "E"] and got[1]["h1"] == ["U"] and got[2]["h2"] == []


def test_reparsing(spark):
    old = spark.createDataFrame([("u1", "Portal", "b", "2020-01-01"), ("u2", "Bueno", "b", None), ("u3", "Portal", "b", None)], "url string, title string, body string, published_date string").withColumns({c: F.lit(None).cast("string") for c in ("subtitle", "authors", "tags", "is_full")})
    fresh = spark.createDataFrame([("u1", "Nuevo", "c", None), ("u2", "Otro", "c", "2021-01-01")], old.select("url", "title", "body", "published_date").schema).withColumns({c: F.lit(None).cast("string") for c in ("subtitle", "authors", "tags", "is_full")})
    got = {r["url"]: (r["title"], r["body"], r["published_date"]) for r in web.reparsed(old, fresh).collect()}
    assert got == {"u1": ("Nuevo", "c", "2020-01-01"), "u2": ("Otro", "c", "2021-01-01"), "u3": ("Portal", "b", None)}
    assert tuple(web.reparse_counts(old, fresh, ("portal",)).first()) == (3, 2, 1, 1)
    assert tuple(web.reparse_counts(old, fresh, ("portal",), only_generic=True).first()) == (3, 1, 1, 1)
    assert {r["title"] for r in web.reparsed(old, fresh, F.col("o.title") == "Portal").collect()} == {"Nuevo", "Bueno", "Portal"}
