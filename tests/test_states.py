"""Folds, ordered scans, rescue, and the states of crawl and enrichment, on small rows."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from pressmill.functions import folds
from pressmill.operators import enrich, lens, ordered, reports, rescue, search, states
from pressmill.sources import archive


def nfkd(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def test_folds_follow_the_unicode_data(spark):
    letters = [chr(c) for c in folds.COVERED if unicodedata.category(chr(c)) != "Cn"]
    texts = letters + ["".join(letters[k : k + 40]) for k in range(0, len(letters), 40)] + ["", "Ǆungla  ﬁn ½\n\t“x” – ‘y’", "ẹ́a"]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", folds.decomposed(F.col("t")).alias("d"), folds.fold_alnum(F.col("t")).alias("a"))
    for r in rows.collect():
        if r["t"] is None:
            assert r["d"] is None and r["a"] is None
        else:
            assert r["d"] == nfkd(r["t"]), hex(ord(r["t"][0]))
            assert r["a"] == "".join(c for c in nfkd(r["t"]).lower() if c in "abcdefghijklmnopqrstuvwxyz0123456789")
    quote = spark.createDataFrame([("  “Será ‘así’” —\n\nﬁn… ",)], "t string").select(folds.fold_quote(F.col("t"))).first()[0]
    assert quote == "\"sera 'asi'\" - fin..."


def test_letters_keep_their_places():
    text = "Ǆ ½—ﬁn É象!"
    plain, places = folds.letters_with_places(text)
    assert plain == "dz12fine象" and [text[p] for p in places] == ["Ǆ", "Ǆ", "½", "½", "ﬁ", "ﬁ", "n", "É", "象"]


def test_titles_are_located_in_one_pass():
    rng = random.Random(8)
    for _ in range(200):
        letters = "".join(rng.choice("abc") for _ in range(rng.randint(0, 400)))
        titles = [letters[(a := rng.randint(0, 380)) : a + rng.randint(0, 60)] + rng.choice(["", "zzz"]) for _ in range(rng.randint(1, 8))]
        want = []
        for t in titles:
            at = next((letters.find(t[:k]) for k in (len(t), 40, 30, 22) if k <= len(t) and t[:k] in letters), None) if len(t) >= 10 else None
            want.append(at)
        assert rescue.located(letters, titles) == want


def test_cuts():
    text = "Intro. El título número uno sigue. Otro título más largo: fin."
    assert [text[a:b] for _, a, b in rescue.cuts(text, ["El TITULO numero, uno", "breve", "otro titulo mas largo"])] == ["El título número uno sigue. ", "Otro título más largo: fin."]
    assert rescue.cuts(text, ["no está en ninguna parte"]) == [(0, 0, len(text))] and rescue.cuts(text, ["nada de nada aquí", "tampoco esto de aquí"]) == []
    assert [(k, a, b) for k, a, b in rescue.cuts("mismo título largo aquí", ["mismo título largo", "mismo título largo"])] == [(0, 0, 0), (1, 0, 23)]


def test_splitting_copies_no_text_to_articles(spark):
    texts = spark.createDataFrame([(1, "x" * 2000)], "issue_id long, text string")
    arts = spark.createDataFrame([(1, k, f"titulo {k} de la lista") for k in range(5)], "issue_id long, id long, title string")
    plan = rescue.split_issue(texts, arts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.index("MapInArrow") < plan.index("Join") < plan.index("Aggregate")


def test_rescue(spark):
    part = "El primer título largo " + "a" * 500 + " Un segundo título largo " + "b" * 1300
    texts = spark.createDataFrame([(1, part), (2, "corto"), (3, part)], "issue_id long, text string")
    rows = [(1, 1, "El primer título largo", "viejo", False), (1, 2, "Un segundo título largo", "viejo", False), (1, 3, "No está en el texto ya", None, False), (2, 4, "Corto", None, False), (3, 5, "El primer título largo", "z" * 600, False), (3, 6, "Un segundo título largo", "viejo", True)]
    arts = spark.createDataFrame(rows, "issue_id long, id long, title string, body string, is_full boolean")
    assert {(r["id"], r["is_full"]) for r in rescue.rescued(texts, arts).collect()} == {(1, False), (2, True)}
    assert {tuple(r) for r in rescue.rescue_states(texts, arts).collect()} == {(1, "ok", 3, 2), (2, "sin-texto", 0, 0), (3, "ok", 1, 0)}


def test_kinds_and_joined_fragments(spark):
    rows = [(1, 0, "Kick", 16.0, 0, 0, 0.0, 10.0, "ASIA"), (1, 1, "Body", 20.0, 0, 1, 0.0, 10.0, "Título"), (1, 2, "Body", 48.0, 0, 2, 0.0, 10.0, "E"), (1, 3, "Body", 10.0, 0, 2, 10.0, 20.0, "n"), (1, 4, "Body", 10.0, 0, 2, 20.5, 30.0, "la"), (1, 5, "Body", 10.0, 0, 2, 35.0, 40.0, "mar"), (1, 6, "Body", 10.0, 0, 3, 0.0, 5.0, "y"), (1, 7, "Body", 10.0, 1, 3, 0.0, 5.0, "sol"), (1, 8, "Furn", 20.0, 1, 4, 0.0, 5.0, "x"), (1, 9, "Body", 14.0, 1, 4, 0.0, 5.0, "x")]
    spans = spark.createDataFrame(rows, "doc int, seq int, font string, size double, page int, line int, x0 double, x1 double, text string")
    spans = spans.withColumn("kind", rescue.kind_of(F.col("font"), F.col("size"), ["Body"], {"Kick": (0, 16.5)}, ["Furn"]))
    assert [r["kind"] for r in spans.orderBy("seq").collect()] == ["antetitulo", "titular"] + ["cuerpo"] * 6 + [None, None]
    assert "|".join(r["text"] for r in rescue.joined(spans).orderBy("seq").collect()) == "ASIA| Título| E|n|la| mar| y| sol"


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_ordered_scans(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.choice("aab"), rng.choice([None, 5, 6, 7]), rng.choice([None, "2020-01-01", "2020-01-01", "2021-02-03", "2022-01-01"]), "articulo") for i in range(90)]
    arts = spark.createDataFrame(rows, "id long, pub_slug string, issue_id long, published_date string, kind string").withColumn("published_date", F.col("published_date").cast("date"))
    got = {r["id"]: (r["previous_id"], r["next_id"]) for r in search.neighbours(arts, parts).collect()}
    want = {}
    for pub in "ab":
        ids = [r[0] for r in sorted((r for r in rows if r[1] == pub and r[3]), key=lambda r: (r[3], r[0]))]
        want |= {i: (a, b) for a, i, b in zip([None, *ids], ids, [*ids[1:], None])}
    assert got == want
    groups = []
    for r in sorted(rows, key=lambda r: (r[3] is None, [-ord(c) for c in r[3] or ""], -r[0])):
        if groups and r[2] is not None and groups[-1][0] == (r[2], r[1]):
            groups[-1][1].append(r[0])
        else:
            groups.append(((r[2], r[1]), [r[0]]))
    assert [r["ids"] for r in search.grouped_all(arts, parts).orderBy("island").collect()] == [g for _, g in groups]


def test_running_sums_and_empty_ranges(spark):
    rows = spark.range(100).withColumn("v", F.col("id") % 3)
    ranged = ordered.in_ranges(rows, F.struct("id"), 7)
    got = [r["s"] for r in ordered.with_running_sum(ranged, F.col("v"), "s").orderBy("id").collect()]
    assert got == [sum(k % 3 for k in range(i + 1)) for i in range(100)]
    assert ordered.without_order(ordered.with_neighbours(ordered.in_ranges(rows.limit(0), F.struct("id"), 3), F.col("id"), "b", "a")).columns == ["id", "v", "b", "a"]


ARTS = [(1, "articulo", True, "2020-01-01", "Uno", "Habrá elecciones en otoño, según todos los sondeos."), (2, "articulo", True, None, "Dos", "cuerpo"), (3, "articulo", False, "2020-01-01", "Tres", "x"), (4, "portada", True, "2020-01-01", "P", "x")]
REPLY = '{"actores": ["ONU", " onu "], "lugares": ["Adén;", "Malí"], "temas": ["control de estrechos", 3], "expectativas": ["habra elecciones en otoño, según todos", "no está en el texto, aunque es larga"]}'


def test_an_enrichment_is_saved_whole(spark, tmp_path, monkeypatch):
    arts = spark.createDataFrame(ARTS, "id long, kind string, is_full boolean, published_date string, title string, body string").withColumns({"published_date": F.col("published_date").cast("date"), "tags": F.array(F.lit("vieja"))})
    done = states.Enrichments(spark, str(tmp_path / "e"))
    done.begin(arts)
    assert [r["id"] for r in done.pending().collect()] == [2, 1]
    now = F.lit("2024-01-01")
    done.sent("b1", "m", 2, now)
    done.sent("b1", "other", 9, now)
    results = spark.createDataFrame([("art-1", "succeeded", REPLY), ("art-2", "errored", None), ("art-99", "succeeded", REPLY), ("x-1", "succeeded", REPLY), ("art-x", "succeeded", REPLY)], "custom_id string, status string, reply string")
    # a failure between two of the tables leaves all as it was
    write, calls = states.Store.change, []

    def failing(store):
        change = write(store)
        replace = change.replace

        def once(name, *rest, **more):
            calls.append(name)
            if name == "articles":
                raise OSError("disk")
            return replace(name, *rest, **more)

        change.replace = once
        return change

    monkeypatch.setattr(states.Store, "change", failing)
    with pytest.raises(OSError):
        done.collect("b1", results, now)
    monkeypatch.undo()
    assert calls == ["entities", "quotes", "articles"] and done.store.read("entities").count() == 0 and [r["id"] for r in done.open_batches().collect()] == ["b1"]
    done.collect("b1", results, now)
    assert {(r["kind"], r["name"]) for r in done.store.read("entities").where("id = 1").collect()} == {("actor", "ONU"), ("lugar", "Adén"), ("lugar", "Malí"), ("tema", "control de estrechos")}
    assert [r["quote"] for r in done.store.read("quotes").collect()] == ["habra elecciones en otoño, según todos"]
    tags = {r["id"]: (r["tags"], r["enrichment_model"], r["enriched_at"] is not None) for r in done.store.read("articles").collect()}
    assert tags[1] == (["control de estrechos", "Adén", "Malí"], "m", True) and tags[2] == (["vieja"], None, False)
    batch = done.store.read("batches").first()
    assert (batch["model"], batch["n_requests"], batch["n_ok"], batch["n_error"]) == ("m", 2, 1, 2)
    assert [r["id"] for r in done.pending().collect()] == [2] and tuple(done.progress().first()) == (2, 1) and not done.open_batches().count()
    number = max(done.store.numbers())
    done.collect("b1", results, now)  # collected already
    done.collect("never sent", results, now)
    assert max(done.store.numbers()) == number


def test_a_crawl_goes_on_where_it_stopped(spark, tmp_path):
    crawl = states.Crawl(spark, str(tmp_path / "c"))
    issues = spark.createDataFrame([("i1", "2020-01-01", ["a", "b"]), ("i2", None, ["b", "c"])], "url string, published_date string, articles array<string>")
    assert crawl.unread_issues(issues).count() == 2
    crawl.note(issues.where("url = 'i1'"), spark.createDataFrame([("a", "ok")], "url string, status string"))
    assert [r["url"] for r in crawl.unread_issues(issues).collect()] == ["i2"]
    crawl.note(issues, spark.createDataFrame([("a", "404"), ("c", "ok")], "url string, status string"))
    assert crawl.store.read("issues").count() == 2 and {tuple(r) for r in crawl.store.read("records").collect()} == {("a", "ok"), ("c", "ok")}
    assert {tuple(r) for r in crawl.targets().collect()} == {("b", "i1", "2020-01-01")}


def test_pages_are_kept_as_they_came(spark, tmp_path):
    import hashlib

    crawl = states.Crawl(spark, str(tmp_path / "c"))
    crawl.save_html(spark.createDataFrame([("u", "<p>á"), ("v", None)], "url string, html string"), F.lit("2024-01-01"))
    crawl.save_html(spark.createDataFrame([("u", "<p>new")], "url string, html string"), F.lit("2024-01-02"))
    key = lambda u: hashlib.sha1(u.encode()).hexdigest() + ".html"
    assert {tuple(r) for r in crawl.html().collect()} == {(key("u"), "u", "<p>new"), (key("v"), "v", None)}
    assert [r["url"] for r in crawl.html(spark.createDataFrame([("v",), ("w",)], "url string")).collect()] == ["v"]
    assert crawl.store.read("html").count() == 3


def test_requests_carry_the_schema(spark):
    arts = spark.createDataFrame([(7, "T", 'b "q"\n'), (8, None, None)], "id long, title string, body string")
    import json

    got = {r["custom_id"]: json.loads(r["request"]) for r in enrich.requests(arts, "Cataloga.", "m", 50).collect()}
    assert got["art-7"]["messages"] == [{"role": "user", "content": 'TÍTULO: T\n\nTEXTO:\nb "q"\n'}] and got["art-8"]["messages"][0]["content"] == "TÍTULO: \n\nTEXTO:\n"
    names = ["actores", "lugares", "temas", "expectativas"]
    schema = {"type": "object", "properties": {n: {"type": "array", "items": {"type": "string"}} for n in names}, "required": names, "additionalProperties": False}
    assert got["art-7"]["output_config"] == {"format": {"type": "json_schema", "schema": schema}} and got["art-7"]["max_tokens"] == 50 and got["art-7"]["system"] == "Cataloga."


def test_tail_counters(spark):
    rows = spark.createDataFrame([("x" * 90 + "\nArtículos relacionados\na",), ("Artículos relacionados " + "x" * 90,), ("Lee también: sigue leyendo",), ("LEE TAMBIEN",), (None,)], "body string")
    got = {r["counter"]: r["n"] for r in reports.tail_counters(rows).collect()}
    assert got == {"cut": 1, "protected": 1, "te puede interesar": 0, "lee tambien": 2, "leer mas": 0, "mas sobre": 0, "articulos recientes": 0, "sigue leyendo": 1}


def test_corpus_selection(spark):
    rows = [(1, "a", "2019-03-01", True), (2, "a", "2020-07-01", True), (3, "b", "2020-01-01", True), (4, "a", "2021-01-01", False), (5, "a", None, True)]
    arts = spark.createDataFrame(rows, "id long, pub_slug string, published_date string, is_full boolean").withColumns({"published_date": F.col("published_date").cast("date"), "kind": F.lit("articulo"), "title": F.lit("Canal largo"), "body": F.lit("mar abierto")})
    ids = lambda **k: {r["id"]: r["period"] for r in lens.corpus(arts, **k).collect()}
    assert ids() == {1: "2019", 2: "2020", 3: "2020"} and ids(half_years=True, pub="a") == {1: "2019-S1", 2: "2020-S2"} and ids(since=2020, only_full=False) == {2: "2020", 3: "2020", 4: "2021"}
    assert lens.discarded(arts).first()[0] == 1 and lens.discarded(arts, "b").first()[0] == 0
    assert [r["id"] for r in lens.examples(lens.corpus(arts), "canal largo", 2).collect()] == [2, 3]


def test_columns_are_added_where_they_lack(spark):
    got = archive.ensure_schema(spark.createDataFrame([("u",)], "url string"), archive.ISSUE_RECORD)
    assert got.columns[0] == "url" and set(got.columns) == set(archive.ISSUE_RECORD.names) and got.first()["number"] is None
