"""Search: stemmer, query language, headlines and the stored index, and the store beneath it."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pressmill.functions.stemmer import regions, stem
from pressmill.operators import index, search
from pressmill.sources.store import Conflict, Store

# published examples of the algorithm
STEMS = """
checa:chec checar:chec checo:chec checoslovaquia:checoslovaqui chefs:chefs chelo:chel chemical:chemical cheque:chequ cheques:chequ
chesca:chesc chester:chest chetumaleños:chetumaleñ cheyenne:cheyenn chía:chi chiapaneca:chiapanec chiapas:chiap chica:chic chicago:chicag
chicana:chican chicano:chican chicas:chic chicharrones:chicharron chichimecas:chichimec chicles:chicl chico:chic torá:tor tórax:torax
torcer:torc toreado:tor toreados:tor toreándolo:tor torear:tor toreara:tor torearlo:tor toreó:tore torero:torer toreros:torer torio:tori
tormenta:torment tormentas:torment tornado:torn tornar:torn tornen:torn torneo:torne tornillo:tornill torniquete:torniquet torno:torn
toronto:toront toros:tor torpedearon:torped torpeza:torpez torrado:torr torralba:torralb torre:torr torrenciales:torrencial
"""


def test_published_stems():
    assert {w: stem(w) for w in re.findall(r"(\w+):", STEMS)} == dict(re.findall(r"(\w+):(\w+)", STEMS))
    assert [stem(w) for w in ("", "a", "ñ", "él", "Fronteras", "fronterizas", "x" * 5000)][:6] == ["", "a", "ñ", "el", "fronter", "fronteriz"]


def test_regions():
    # RV after the third letter, after the next consonant, after the next vowel
    assert [w[regions(w)[0] :] for w in ("macho", "oliva", "trabajo", "áureo")] == ["ho", "va", "bajo", "eo"]
    assert [w[regions("animadversion")[k] :] for k, w in ((1, "animadversion"), (2, "animadversion"))] == ["imadversion", "adversion"]


ROWS = [
    (1, "w", 1, "2020-01-01", "Las fronteras", None, "El tratado de paz llega."),
    (2, "w", 1, "2021-01-01", "Otra", "frontera abierta", "Nada"),
    (3, "b", 2, "2022-01-01", "Paz", None, None),
    (4, "w", None, "2010-01-01", "Guerra", "paz", "paz de tratado, tratado y paz"),
    (5, "w", 3, "2010-01-01", "Portada de paz", None, "paz"),
]


@pytest.fixture(scope="module")
def arts(spark):
    rows = spark.createDataFrame(ROWS, "id long, pub_slug string, issue_id long, published_date string, title string, subtitle string, body string")
    return rows.withColumn("published_date", F.col("published_date").cast("date")).withColumn("kind", F.when(F.col("id") == 5, "portada").otherwise("articulo"))


QUERIES = {
    "frontera": {1, 2}, "frontera -tratado": {2}, '"tratado de paz"': {1}, "nada or paz": {1, 2, 3, 4}, "": set(), "-paz": {2}, "-frontera": {3, 4},
    "guerra or -paz": {2, 4}, "-paz -nada": set(), '-"de tratado"': {1, 2, 3}, "paz -guerra -fronteras": {3}, "or": set(), "paz or": {1, 3, 4}, '"paz paz"': set(), "TRATADOS": {1, 4},
}


@pytest.mark.parametrize("query", QUERIES)
def test_queries_are_set_algebra(spark, arts, query):
    rows = search.pieces(arts)
    ranked = {r["id"]: r["rank"] for r in search.ranked(search.postings(rows, search.query_stems(query)), query, rows).collect()}
    assert set(ranked) == QUERIES[query]
    assert all((rank > 0) == any(s in map(stem, re.findall(r"\w+", " ".join(x or "" for x in ROWS[i - 1][4:]).lower())) for s in search.query_stems(query, True)) for i, rank in ranked.items())


def test_random_queries_against_brute_force(spark):
    rng = random.Random(5)
    words = "ala bote cine dado".split()
    texts = {i: " ".join(rng.choice(words) for _ in range(rng.randint(0, 5))) for i in range(40)}
    rows = spark.createDataFrame([(i, None, None, t) for i, t in texts.items()], "id long, title string, subtitle string, body string")
    posted = search.postings(rows).persist()
    for _ in range(12):
        alternatives = [[(rng.random() < 0.5, [rng.choice(words) for _ in range(rng.randint(1, 2))]) for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 3))]
        query = " or ".join(" ".join(("" if yes else "-") + f'"{" ".join(p)}"' for yes, p in a) for a in alternatives)
        holds = lambda t, p: f" {' '.join(p)} " in f" {t} "
        want = {i for i, t in texts.items() if any(all(holds(t, p) == yes for yes, p in a) for a in alternatives)}
        assert {r["id"] for r in search.matches(posted, query, rows).collect()} == want, query


def test_fragments_against_brute_force():
    rng = random.Random(6)
    for _ in range(400):
        n = rng.randint(0, 120)
        hits = sorted(rng.sample(range(n), min(n, rng.randint(0, 12))))
        few, many = rng.choice([(15, 30), (3, 8)])
        spans = [(h, min(n, max(max(x for x in hits if h <= x < h + many) + 1, h + few)), sum(h <= x < h + many for x in hits)) for h in hits]
        want = []
        for _ in range(2):
            free = [s for s in spans if all(s[1] <= a or b <= s[0] for a, b in want)]
            if free:
                want.append(max(free, key=lambda s: (s[2], -s[0]))[:2])
        assert search.fragments(hits, n, few, many) == (sorted(want) or [(0, min(n, few))])


def test_headlines():
    body = "uno " * 50 + "guerra " + "dos " * 50 + "guerras y paz " + "tres " * 50
    text = search.headline(body, frozenset(map(stem, ["guerra", "paz"])))
    first, second = text.split(" … ")
    assert first.split() == ["<mark>guerra</mark>"] + ["dos"] * 14 and second.split()[:3] == ["<mark>guerras</mark>", "y", "<mark>paz</mark>"] and len(second.split()) == 15
    assert search.headline(None, frozenset()) is None and search.headline("", frozenset()) == "" and search.headline("a b", frozenset()) == "a b"


def test_index_equals_search_without_index(spark, arts, tmp_path):
    found = index.Index(spark, str(tmp_path / "i"))
    found.add(arts, buckets=7)
    for query in QUERIES:
        assert {r["id"] for r in found.hits(query).collect()} == QUERIES[query], query
    plain, stored = (sorted(map(tuple, df.collect())) for df in (search.results(arts, "paz", since=2010), found.view(arts, "paz", since=2010)))
    assert plain == stored and len(plain) == 3
    assert [r["id"] for r in found.view(arts, "paz", number=2, size=2).collect()] == [sorted(plain)[2][2]]


def test_index_is_added_to_and_taken_from(spark, arts, tmp_path):
    found = index.Index(spark, str(tmp_path / "i"))
    found.add(arts.where("id <= 2"))
    found.add(arts.where("id >= 2").withColumn("body", F.when(F.col("id") == 2, "paz nueva").otherwise(F.col("body"))))
    assert {r["id"] for r in found.hits("paz").collect()} == {1, 2, 3, 4} and not found.hits("nada").count() and found.pieces().count() == 4
    found.remove(spark.createDataFrame([(1,), (99,)], "id long"))
    assert {r["id"] for r in found.hits("paz").collect()} == {2, 3, 4} and {r["id"] for r in found.hits("-paz").collect()} == set()
    found.add(arts.where("id = 1"))
    assert {r["id"] for r in found.hits("paz").collect()} == {1, 2, 3, 4}
    before = {(r["id"], r["rank"]) for r in found.hits("paz or frontera").collect()}
    found.compact()
    assert {(r["id"], r["rank"]) for r in found.hits("paz or frontera").collect()} == before and found.pieces().count() == 4
    assert not found.store.has("replaced") and all(len(t["parts"]) == 1 for t in found.store.state()["tables"].values())


def test_a_search_reads_no_text_but_that_of_its_page(spark, arts, tmp_path):
    arts.write.parquet(str(tmp_path / "arts"))
    stored = spark.read.parquet(str(tmp_path / "arts"))
    found = index.Index(spark, str(tmp_path / "i"))
    found.add(stored)
    plan = found.hits("paz -guerra")._jdf.queryExecution().executedPlan().toString()
    assert not any("body" in columns for columns in re.findall(r"ReadSchema: struct<(.*?)>\n", plan))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and re.search(r"PushedFilters: \[[^\]]*In\(stem, \[guerr,paz\]\)", plan)
    view = found.view(stored, "paz", size=2)._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[In\(id, \[\d+,\d+\]\)", view)


def test_empty_index(spark, arts, tmp_path):
    found = index.Index(spark, str(tmp_path / "i"))
    found.add(arts.limit(0))
    assert found.hits("paz").count() == 0 and found.view(arts, "-paz").count() == 0


def test_a_change_that_fails_between_two_tables_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with store.change() as change:
        change.replace("a", spark.range(3))
        change.replace("b", spark.range(4).selectExpr("id", "id % 2 as part"), by=["part"])
    with pytest.raises(ZeroDivisionError), store.change() as change:
        change.append("a", spark.range(3, 6))
        1 / 0
    assert store.numbers() == [1] and store.read("a").count() == 3
    with store.change() as change:
        change.append("a", spark.range(3, 6))
        change.append("b", spark.range(4, 6).selectExpr("id", "id % 2 as part"), by=["part"])
    assert sorted(r["id"] for r in store.read("a").collect()) == [*range(6)] and store.read("a", 1).count() == 3
    assert {(r["id"], r["part"]) for r in store.read("b").collect()} == {(i, i % 2) for i in range(6)}
    gone = store.recover(keep=1)
    assert len(gone) == 1 and store.numbers() == [2] and store.read("a").count() == 6
    with pytest.raises(ValueError), store.change() as change:
        change.append("a", spark.range(2).selectExpr("id as other"))


def test_of_two_changes_from_one_state_one_wins(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(Conflict), store.change() as first:
        first.replace("a", spark.range(1))
        with store.change() as second:
            second.replace("a", spark.range(2))
    assert store.read("a").count() == 2
