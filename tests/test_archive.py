"""Sources, upserts, pages, search and rescue on small rows written for them."""

import pytest
from pyspark.sql import functions as F

from pressmill.operators import enrich, merge, rescue, search, web
from pressmill.sources import archive


def test_jsonl(spark, tmp_path):
    good, bad = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    good.write_text('{"url": "u", "title": "t", "tags": ["x"]}\n\n{"url": "v"}\n')
    bad.write_text('{"url": \n')
    assert archive.read_jsonl(spark, str(good), archive.ARTICLE_RECORD).count() == 2
    assert archive.read_jsonl(spark, str(tmp_path / "none"), archive.ARTICLE_RECORD).count() == 0
    with pytest.raises(Exception):
        archive.read_jsonl(spark, str(bad), archive.ARTICLE_RECORD).collect()
    archive.append_jsonl(spark.createDataFrame([("u",)], "url string"), str(tmp_path / "out"))
    archive.append_jsonl(spark.createDataFrame([("v",)], "url string"), str(tmp_path / "out"))
    assert archive.read_jsonl(spark, str(tmp_path / "out"), archive.ARTICLE_RECORD).count() == 2


def test_numbered_files(spark, tmp_path):
    for name in ("weekly-12.pdf", "the-monthly-7.pdf", "other.pdf"):
        (tmp_path / name).write_bytes(b"%PDF")
    got = archive.numbered_files(spark, str(tmp_path)).collect()
    assert sorted((r["slug"], r["number"]) for r in got) == [("the-monthly", 7), ("weekly", 12)]


def test_upsert_is_idempotent_and_keeps_nulls(spark):
    old = spark.createDataFrame([("a", "x", 1, "p"), ("b", "y", 2, "p")], "url string, title string, issue int, pub string")
    new = spark.createDataFrame([("a", None, None, "q"), ("c", "z", 3, "q")], "url string, title string, issue int, pub string")
    once = merge.upsert(old, new, "url", ["title"], ["issue"], ["pub"])
    want = [("a", None, 1, "p"), ("b", "y", 2, "p"), ("c", "z", 3, "q")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, merge.upsert(once, new, "url", ["title"], ["issue"], ["pub"]).collect())) == want


def test_replies(spark):
    body = "El ministro dijo que «la frontera se abrirá antes de fin de año» ante la prensa."
    rows = [(1, '{"actores": ["Ana  Paz.", "ana paz", 7], "temas": ["x", "yy"], "expectativas": ["la frontera se abrira antes de fin de ano", "nunca"]}'), (2, "[1]"), (3, "nope"), (4, "{}"), (5, None)]
    p = enrich.parsed(spark.createDataFrame(rows, "id int, reply string"))
    assert {r["id"]: r["usable"] for r in p.collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}
    assert sorted(map(tuple, enrich.entities(p).collect())) == [(1, "actor", "Ana Paz"), (1, "tema", "yy")]
    quotes = enrich.verified_quotes(p, spark.createDataFrame([(1, body), (4, None)], "id int, body string"))
    assert sorted(map(tuple, quotes.collect())) == [(1, 1, 1), (4, 0, 0)]


PAGE = """<html><head><title>Site | Name</title><meta property="og:description" content="Un resumen"><meta property="article:tag" content="Asia">
<script type="application/ld+json">{"@graph": [{"@type": "WebSite"}, {"@type": "NewsArticle", "headline": "El titular", "author": [{"name": "Ana"}, {"name": "Luis"}], "datePublished": "2020-05-06T10:00:00"}]}</script>
</head><body><h1>Site</h1><article><div class="entry-content"><p>Uno <b>dos</b>.</p><div class="related"><p>No</p></div><p>Tres.</p></div></article>
<a href="/articulo/a//b/?x=1#y">a</a><a href="https://other.example/z">z</a><a href="/articulo/a/b/">again</a><a href="#top">top</a></body></html>"""


def test_pages(spark):
    pages = spark.createDataFrame([(1, "https://h.example/articulo/x/?q=1", PAGE), (2, "https://h.example/articulo/mayo-junio-2017/", None)], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in web.article_records(pages, generic=("site",)).collect()}
    first = rows[1]
    assert (first["title"], first["subtitle"], first["authors"], first["published_date"], first["tags"]) == ("El titular", "Un resumen", ["Ana", "Luis"], "2020-05-06", ["Asia"])
    assert first["body"] == "Uno dos .\n\nTres." or first["body"] == "Uno dos.\n\nTres."
    assert first["url"] == "https://h.example/articulo/x/" and not first["is_full"] and rows[2]["kind"] == "portada"
    links = {r["page_id"]: r["links"] for r in web.same_site_links(pages).collect()}
    assert links == {1: ["https://h.example/articulo/a/b/"], 2: []}
    assert [r["link"] for r in web.article_links(web.same_site_links(pages), ["^/articulo/"], ["/archivo/"]).collect()] == ["https://h.example/articulo/a/b/"]


def test_grouping_keeps_the_order(spark):
    rows = [(1, 10, "w", 5), (2, 11, "w", 5), (3, 12, "w", 6), (4, 13, "w", 5), (5, 14, "w", None), (6, 15, "w", None)]
    df = spark.createDataFrame(rows, "pos int, id int, pub_slug string, issue_id int").withColumn("published_date", F.lit(None).cast("date"))
    assert [r["ids"] for r in search.grouped(df).orderBy("island").collect()] == [[10, 11], [12], [13], [14], [15]]


def test_sections(spark):
    long = "Texto impu- sieran " + "x" * 600
    rows = [("cuerpo", "suelto"), ("antetitulo", " Asia "), ("titular", "Un título"), ("titular", " partido"), ("cuerpo", long), ("titular", "Corto"), ("cuerpo", "nada"), ("titular", "Último"), ("cuerpo", long), ("cuerpo", " más")]
    df = spark.createDataFrame([(1, i, k, t) for i, (k, t) in enumerate(rows)], "doc int, seq int, kind string, text string")
    got = rescue.sections(df).orderBy("place").collect()
    assert [(r["place"], r["kicker"], r["title"]) for r in got] == [(1, "Asia", "Un título partido"), (3, "", "Último")]
    assert got[0]["body"].startswith("Texto impusieran ") and got[1]["body"].endswith(" más")


def test_issue_titles_and_twins(spark):
    titles = ["#ISPE 12", "#ISPE 12 - 3 de mayo de 2019", "#ispe 870", "ISPE nº 870, 14 ene 2014", "Informe semanal de Política Exterior nº 870", "#ISPE 870 – enero 2014", "#ISPE 12: La paz", "La paz", "", "ISPE enero rojo"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in titles], "t string").select(rescue.issue_title(F.col("t"))).collect()]
    assert got == [True] * 6 + [False] * 4
    text = "Érase una vez " * 20
    found = spark.createDataFrame([(1, 7, 1, text), (1, 7, 2, "otra cosa " * 20)], "doc int, issue_id int, place int, body string")
    arts = spark.createDataFrame([(7, 1, text.upper()), (7, 2, "distinto " * 30)], "issue_id int, id int, body string")
    assert [(r["place"], r["id"]) for r in rescue.twins(found, arts).collect()] == [(1, 1)]


def test_issue_text_is_dealt_out(spark):
    texts = spark.createDataFrame([(1, "Índice. La primera nota larga empieza aquí. Segunda nota de prueba: fin.")], "issue_id int, text string")
    arts = spark.createDataFrame([(1, 1, "La primera nota larga"), (1, 2, "Segunda nota de prueba"), (1, 3, "Breve")], "issue_id int, id int, title string")
    got = {r["id"]: r["part"] for r in rescue.split_issue(texts, arts).collect()}
    assert got == {1: "La primera nota larga empieza aquí.", 2: "Segunda nota de prueba: fin."}


def test_streamed_records_become_snapshots(spark, tmp_path):
    from pressmill.sources import snapshots
    from pressmill.streaming.ingest import ingest

    incoming, state, checkpoint = (str(tmp_path / n) for n in ("in", "state", "checkpoint"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"url": "u", "title": "one", "published_date": "2020-01-01", "publication": "p", "scraped_at": "1"}\n{"url": "u", "title": "two", "scraped_at": "2"}\n')
    ingest(spark, incoming, state, checkpoint).awaitTermination(120)
    (tmp_path / "in" / "b.json").write_text('{"url": "u", "subtitle": "s", "issue_url": "i", "publication": "q", "scraped_at": "3"}\n{"url": "v", "title": "new", "scraped_at": "3"}\n')
    ingest(spark, incoming, state, checkpoint).awaitTermination(120)
    rows = {r["url"]: r for r in snapshots.current(spark, state).collect()}
    assert snapshots.versions(spark, state) == [1, 2] and set(rows) == {"u", "v"}
    assert (rows["u"]["title"], rows["u"]["subtitle"], rows["u"]["issue_url"], rows["u"]["publication"]) == (None, "s", "i", None)
    ingest(spark, incoming, state, checkpoint).awaitTermination(120)
    assert snapshots.versions(spark, state) == [1, 2]
    assert snapshots.write_version(snapshots.current(spark, state), state) == 3


def test_issue_text_with_an_only_article_and_other_accents(spark):
    texts = spark.createDataFrame([(1, "todo el texto"), (2, "Antes. François Bayrou llega al poder: así. Después viene Größe und Maß: fin")], "issue_id int, text string")
    arts = spark.createDataFrame([(1, 1, "sin relación ninguna"), (2, 2, "François Bayrou llega al poder"), (2, 3, "Después viene")], "issue_id int, id int, title string")
    got = {r["id"]: r["part"] for r in rescue.split_issue(texts, arts).collect()}
    assert got == {1: "todo el texto", 2: "François Bayrou llega al poder: así.", 3: "Después viene Größe und Maß: fin"}


def test_pages_that_are_odd(spark, tmp_path):
    from pressmill.sources.archive import read_html

    (tmp_path / "a.html").write_bytes(b"<p>a\xffb</p>")
    assert read_html(spark, str(tmp_path)).first()["html"] == "<p>a\ufffdb</p>"
    html = "<div class=entry-content><header>cab</header><p>texto</p><p class='related x'>no</p><p class=overflow-related>sí</p><div class=paywall><p>pago</p></div></div>"
    rows = spark.createDataFrame([(1, None, None), (2, "http://x/y", html), (3, "http://x/z", "<meta property='og:description' content='Grupo editorial X'><article><p>" + "a " * 700 + "Hazte suscriptor</p></article>")], "page_id int, url string, html string")
    got = {r["page_id"]: r for r in web.article_records(rows, prefixes=("grupo editorial",)).collect()}
    assert got[1]["title"] is None and got[2]["body"] == "texto\n\nsí" and got[3]["subtitle"] is None and not got[3]["is_full"]


def test_assembled_records(spark):
    rows = spark.createDataFrame([(1, "http://x/a", "t", True, None, "i", "2014-01-14", False), (2, "http://x/b", "t", False, "2015-01-01", None, None, False), (3, "http://x/c", "t", True, None, None, None, True)], "page_id int, url string, title string, is_full boolean, published_date string, issue_url string, issue_date string, missing boolean")
    got = {r["page_id"]: r for r in web.assembled(rows, "weekly", F.current_timestamp()).collect()}
    assert [(got[k]["status"], got[k]["published_date"], got[k]["publication"]) for k in (1, 2, 3)] == [("ok", "2014-01-14", "weekly"), ("paywalled", "2015-01-01", "weekly"), ("404", None, None)]
    assert got[3]["title"] is None and got[1]["raw_html_path"].endswith(".html")


def test_search_results_rank_first(spark):
    rows = [(1, "weekly", 1, "2020-01-01", "La paz", None, "nada aquí"), (2, "weekly", 1, "2021-01-01", "Otro", None, "paz y paz y paz"), (3, "bimonthly", 2, "2022-01-01", "Guerra", None, "sin tema"), (4, "weekly", None, "2010-01-01", "Paz", "paz", "paz")]
    arts = spark.createDataFrame(rows, "id int, pub_slug string, issue_id int, published_date string, title string, subtitle string, body string").withColumn("kind", F.lit("articulo")).withColumn("published_date", F.col("published_date").cast("date"))
    by_rank = [r["id"] for r in search.results(arts, "paz").collect()]
    assert by_rank == [4, 1, 2] and [r["id"] for r in search.results(arts, "paz", by_rank=False).collect()] == [2, 1, 4]
    assert [r["id"] for r in search.results(arts, "paz", since=2020, pub="weekly").collect()] == [1, 2]
    assert {r["id"]: r["snippet"] for r in search.results(arts, "paz").collect()}[2] == "<mark>paz</mark> y <mark>paz</mark> y <mark>paz</mark>"
    assert {r["id"]: (r["pos"], r["island"]) for r in search.results(arts, "paz", by_rank=False).collect()} == {2: (1, 1), 1: (2, 1), 4: (3, 2)}


def test_titles_and_paragraphs_keep_their_digits(spark):
    body = "x" * 700
    rows = [("titular", " 10 años de 2010"), ("titular", "11 de 11 "), ("cuerpo", body)]
    df = spark.createDataFrame([(1, i, k, t) for i, (k, t) in enumerate(rows)], "doc int, seq int, kind string, text string")
    assert rescue.sections(df).first()["title"] == "10 años de 2010 11 de 11"
    texts = spark.createDataFrame([("0 a 0\n\n 1 b 1\n\n  \n\n2",)], "body string")
    assert texts.select(search.paragraphs().alias("p")).first()["p"] == ["0 a 0", "1 b 1", "2"]
