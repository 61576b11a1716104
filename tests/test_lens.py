"""Planted trends are found, constants and filler aren't, whether texts grow longer or not."""

import datetime
import hashlib
import math
import random
from collections import Counter
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pressmill.functions import stats
from pressmill.functions.text import spanish_date, split_tail, tail_at, terms
from pressmill.operators import entities, lens

#: Words without a trend, and pairs of words with the share of documents that hold them in period k of 9.
GROUND = [f"{a}{b}" for a in ("lomo", "risco", "valle", "senda", "arena") for b in ("bravo", "claro", "denso", "firme")]
TRENDS = {
    "puente colgante": lambda k: 0.04 + 0.3 * (k == 8),  # at once
    "vidrio soplado": lambda k: 0.02 + 0.00012 * k**4,  # ever faster
    "faro apagado": lambda k: 0.45 - 0.05 * k,  # fading
    "molino viejo": lambda k: 0.3,
    "noria lenta": lambda k: 0.25 + 0.1 * (k % 2),  # to and fro
}


def planted(seed, stretch):
    """Half years 2018-1 to 2022-1, 220 documents each; from the middle on texts are ``stretch`` times as long."""
    rng = random.Random(seed)
    for k in range(9):
        for j in range(220):
            length = stretch if k > 4 else 1
            body = [f"{rng.choice(GROUND)} {rng.choice(GROUND)}" for _ in range(20 * length)]
            body += [pair for pair, share in TRENDS.items() if any(rng.random() < share(k) for _ in range(length))]
            rng.shuffle(body)
            yield Row(id=1000 * k + j, published_date=datetime.date(2018 + k // 2, 1 + 6 * (k % 2) + j % 6, 1 + j % 28), title="sin tema", body="; ".join(body), kind="articulo", is_full=True)


def truth(up):
    """Trends whose share in the last period is that many times the mean of the five before it, or that part of it."""
    mean = {t: sum(share(k) for k in range(3, 8)) / 5 for t, share in TRENDS.items()}
    return {t for t, share in TRENDS.items() if (share(8) >= 2 * mean[t] if up else share(8) <= mean[t] / 2)}


@pytest.mark.parametrize("seed,stretch", [(11, 1), (12, 3)])
def test_planted_trends(spark, seed, stretch):
    docs = lens.corpus(spark.createDataFrame(list(planted(seed, stretch))), half_years=True)
    assert docs.select("period").distinct().count() == 9
    c = lens.counted(docs, least_terms=10)
    for up in (True, False):
        found = {r["term"] for r in lens.changes(c, up).collect()}
        assert found & set(TRENDS) == truth(up) and not found & set(GROUND)
        assert {r["term"] for r in lens.rising_top(docs, rising=up).collect()} & set(TRENDS) == truth(up)
    assert truth(True) == {"puente colgante", "vidrio soplado"} and truth(False) == {"faro apagado"}


def test_terms_follow_the_rule(spark):
    text = "El golfo de Adén, y la Nación. Mar rojo!"
    row = spark.createDataFrame([(text,)], "t string").select(terms(F.col("t"), ["rojo"]).alias("x")).first()["x"]
    assert set(row) == {"golfo", "aden", "nacion", "golfo aden", "aden nacion"}


def log_factorial(n):
    if n < 200:
        return Decimal(math.factorial(n)).ln()
    d, pi = Decimal(n), Decimal("3.14159265358979323846264338327950288419716939937510")
    return d * d.ln() - d + (2 * pi * d).ln() / 2 + 1 / (12 * d) - 1 / (360 * d**3) + 1 / (1260 * d**5) - 1 / (1680 * d**7) + 1 / (1188 * d**9)


def exact_tail(n, total, p, upper):
    """Term after term with 50 digits, until none counts any more."""
    with localcontext() as context:
        context.prec = 50
        if not upper:
            return exact_tail(total - n, total, 1 - Decimal(p), True)
        p = Decimal(p)
        if n > total:
            return 0.0
        if n <= total * p:  # what the lower terms leave of 1
            return 1 - exact_tail(n - 1, total, p, False) if n > 0 else 1.0
        term = (log_factorial(total) - log_factorial(n) - log_factorial(total - n) + n * p.ln() + (total - n) * (1 - p).ln()).exp()
        whole, k = term, n
        while k < total and term > whole * Decimal("1e-20"):
            term *= (total - k) * p / ((k + 1) * (1 - p))
            whole, k = whole + term, k + 1
        return float(whole)


def test_binomial_tails_in_constant_steps(spark):
    cases = [(3, 20, 0.05), (0, 50, 0.1), (50, 50, 0.9), (49, 50, 0.9), (7, 900, 0.03), (0, 30, 0.2), (5, 4, 0.2), (1, 1, 0.5), (0, 0, 0.3), (6, 250, 0.0), (1, 1000, 1e-12), (999, 1000, 0.999)]
    cases += [(n, 1000, p) for p in (0.001, 0.02, 0.3, 0.5, 0.97) for n in (0, 1, 5, 14, 15, 16, 20, 21, 60, 299, 300, 301, 499, 500, 501, 600, 969, 970, 971, 999, 1000)]
    cases += [(n, 10**8, p) for p, ns in ((1e-7, (1, 10, 11, 30, 60)), (1e-3, (98_000, 99_999, 100_000, 100_001, 100_400, 103_000, 110_000)), (0.4, (39_990_000, 40_000_000, 40_010_000, 40_050_000))) for n in ns]
    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, n long, total long, p double")
    got = rows.select("k", stats.upper_tail(F.col("n"), F.col("total"), F.col("p")).alias("up"), stats.lower_tail(F.col("n"), F.col("total"), F.col("p")).alias("low")).orderBy("k").collect()
    for (n, total, p), r in zip(cases, got):
        p = min(max(p, 1e-12), 1 - 1e-12)
        for upper, x in ((True, r["up"]), (False, r["low"])):
            want = 1.0 if total == 0 or (upper and n == 0) or (not upper and n >= total) else exact_tail(n, total, p, upper)
            assert x == pytest.approx(float(want), rel=1e-9, abs=1e-300), (n, total, p, upper)
    plan = rows.select(stats.upper_tail(F.col("n"), F.col("total"), F.col("p")))._jdf.queryExecution().toString()
    assert "sequence(" not in plan


def test_entities_rise_fall_and_appear(spark):
    rng, arts, ents = random.Random(3), [], []
    for i in range(720):
        year = 2021 + i // 120
        arts.append(Row(id=i, published_date=datetime.date(year, 2, 2), kind="articulo", is_full=True, enriched=True))
        chance = {"steady": 0.3, "riser": 0.02 if year < 2026 else 0.5, "gone": 0.3 if year < 2026 else 0.0, "fresh": 0.0 if year < 2026 else 0.3}
        ents += [Row(article_id=i, kind="actor", name=k) for k, p in chance.items() if rng.random() < p]
    a, e = spark.createDataFrame(arts), spark.createDataFrame(ents)
    found = {c: {r["name"] for r in entities.entity_changes(a, e, c).collect()} for c in ("rising", "falling", "new")}
    assert found == {"rising": {"riser"}, "falling": {"gone"}, "new": {"fresh"}}


def test_canonical_names(spark):
    rows = [(1, "lugar", "París"), (1, "lugar", "PARIS"), (2, "lugar", "París"), (3, "lugar", "Paris")]
    e = spark.createDataFrame(rows, "article_id long, kind string, name string")
    once = entities.canonicalised(e)
    assert sorted(map(tuple, once.collect())) == [(1, "lugar", "París"), (2, "lugar", "París"), (3, "lugar", "París")]
    assert sorted(map(tuple, entities.canonicalised(once).collect())) == sorted(map(tuple, once.collect()))


@pytest.mark.parametrize("label", ["Artículos relacionados", "ARTICULOS RELACIONADOS", "artículos Relacionados:"])
def test_tails(spark, label):
    body = "Una frase larga. " * 40 + "\n \n" + label + "\nUno\nDos"
    row = spark.createDataFrame([(body,), (label + "\n" + "x" * 500,), ("",), (None,)], "t string").select("t", tail_at(F.col("t")).alias("at"), split_tail(F.col("t")).alias("s")).collect()
    assert row[0]["s"]["head"] == ("Una frase larga. " * 40).rstrip() and row[0]["s"]["head"] + row[0]["s"]["tail"] == body
    assert [r["at"] for r in row[1:]] == [None, None, None]


def test_spanish_dates(spark):
    rows = [("Madrid, 3 de Marzo de 2019.",), ("el 31 de DICIEMBRE de 1999",), ("marzo de 2019",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(spanish_date(F.col("t"))).collect()]
    assert got == ["2019-03-03", "1999-12-31", None, None]


def test_backtest_counts_hits_of_flagged_terms_and_controls(spark):
    """Terms that stir before the cut: one reaches a title within the horizon, one only after it, one never."""
    rng, rows = random.Random(9), []
    stirring = {"grieta honda": 2021, "niebla baja": 2025, "arco roto": None}
    for year in range(2014, 2026):
        for k in range(40):
            body = [f"{rng.choice(GROUND)} {rng.choice(GROUND)}" for _ in range(20)]
            body += [t for i, t in enumerate(stirring) if 2016 < year <= 2020 and k < 2 * (year - 2015) - i]
            title = next((t for t, y in stirring.items() if y == year and k == 0), "sin tema")
            rows.append(Row(id=100 * year + k, published_date=datetime.date(year, 1 + k % 12, 1), title=title, body="; ".join(body), kind="articulo", is_full=True))
    docs = lens.corpus(spark.createDataFrame(rows))
    got = lens.backtest(docs, cut="2020", horizon=3).first()
    flagged = {r["term"] for r in lens.weak_signals(docs, lens.counted(docs), 4, "2020", 25).collect()}
    reached = {r["term"] for r in docs.where("period between '2021' and '2023'").selectExpr("explode(title_terms) as term").distinct().collect()}
    assert "grieta honda" in flagged and flagged & set(stirring) == set(stirring)
    assert (got["cut"], got["flagged_n"], got["flagged_hits"]) == ("2020", len(flagged), len(flagged & reached)) and got["flagged_hits"] >= 1
    assert got["control_hits"] == 0 and got["beats_control"]


@pytest.mark.parametrize("apart", [True, False])
def test_backtest_of_terms_in_documents_apart_and_in_the_same(spark, apart):
    """In documents of their own all three terms are flagged; where each one's documents hold the next one's, the rarest stands
    for all: of equal rises it comes first, and every one of its documents has the others. Their words are like terms for the control."""
    rng, rows = random.Random(9), []
    stirring = {"grieta honda": 2021, "niebla baja": 2025, "arco roto": None}
    for year in range(2014, 2026):
        for k in range(40):
            body = [f"{rng.choice(GROUND)} {rng.choice(GROUND)}" for _ in range(20)]
            body += [t for i, t in enumerate(stirring) if 2016 < year <= 2020 and 0 <= k - 13 * i * apart < 2 * (year - 2015) - i]
            title = next((t for t, y in stirring.items() if y == year and k == 0), "sin tema")
            rows.append(Row(id=100 * year + k, published_date=datetime.date(year, 1 + k % 12, 1), title=title, body="; ".join(body), kind="articulo", is_full=True))
    docs = lens.corpus(spark.createDataFrame(rows))
    flagged = {r["term"] for r in lens.weak_signals(docs, lens.counted(docs), 4, "2020", 25).collect()}
    assert flagged & set(stirring) == (set(stirring) if apart else {"arco roto"})
    known = docs.collect()
    total = Counter(t for r in known if r["period"] <= "2020" for t in r["terms"])
    before, reached = ({t for r in known if a <= r["period"] <= b for t in r["title_terms"]} for a, b in (("2014", "2020"), ("2021", "2023")))
    like = {t for t, n in total.items() if lens.SIGNAL_LEAST <= n <= lens.SIGNAL_MOST} - before - flagged
    control = set(sorted(like, key=lambda t: (hashlib.md5(f"7:{t}".encode()).hexdigest(), t))[:200])
    got = lens.backtest(docs, cut="2020", horizon=3).first()
    assert (got["flagged_n"], got["flagged_hits"]) == (len(flagged), int(apart)) == (len(flagged), len(flagged & reached))
    assert (got["control_n"], got["control_hits"]) == (200, len(control & reached)) and got["control_hits"] > 0 and got["beats_control"] == apart
