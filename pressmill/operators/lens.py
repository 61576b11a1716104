"""Attention lenses: document frequencies of terms by period, corrected for text length, and what rises, falls or stirs.

Periods are few (years or half years), so a term's counts by period are one array, made by one aggregation over terms
with partial sums: the grid of terms and periods needs no join. Tests run after the cheap filters, on the survivors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import LongType, StructField, StructType

from pressmill.functions.stats import binomial_tail
from pressmill.functions.text import STOPWORDS, terms
from pressmill.operators.reports import long

LEAST_TOTAL, SUPPORT, LIFT, ALPHA = 4, 6, 1.6, 0.01
BASE_LEAST, BASE_MOST, TOP = 3, 5, 80


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt anew by id where a scan of few files would leave processors idle; a large table keeps its splits."""
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition("id") if rows.rdd.getNumPartitions() < wanted else rows


def selected(arts: DataFrame, pub: str | None = None, since: int = 0) -> DataFrame:
    rows = arts.where((F.col("kind") != "portada") & F.col("published_date").isNotNull())
    rows = rows.where(F.col("pub_slug") == pub) if pub else rows
    return rows.where(F.year("published_date") >= since) if since else rows


def discarded(arts: DataFrame, pub: str | None = None, since: int = 0) -> DataFrame:
    """(discarded): how many pieces are left out of the corpus only because they aren't full."""
    return selected(arts, pub, since).agg(long(F.count_if(~F.col("is_full"))).alias("discarded"))


def corpus(arts: DataFrame, stopwords: list[str] = STOPWORDS, half_years: bool = False, pub: str | None = None, since: int = 0, only_full: bool = True) -> DataFrame:
    """(id, date, period, terms, title_terms) of dated pieces, full ones by default, of one publication or since a year if asked."""
    rows = selected(arts, pub, since)
    rows = spread(rows.where("is_full") if only_full else rows)
    year = F.year("published_date").cast("string")
    period = F.concat(year, F.when(F.month("published_date") <= 6, "-S1").otherwise("-S2")) if half_years else year
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(". "), F.coalesce("body", F.lit("")))
    return rows.select("id", F.col("published_date").alias("date"), period.alias("period"), terms(text, stopwords).alias("terms"), terms(F.coalesce("title", F.lit("")), stopwords).alias("title_terms"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(term, total) of the terms that enough documents have."""
    return docs.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("total")).where(F.col("total") >= LEAST_TOTAL)


def term_period(docs: DataFrame) -> DataFrame:
    """(term, period, n) of the vocabulary; a term's counts come together in its total's aggregation, so one shuffle does."""
    counted = docs.select(F.explode("terms").alias("term"), "period").groupBy("term", "period").agg(F.count("*").alias("n"))
    both = counted.groupBy("term").agg(F.sum("n").alias("total"), F.collect_list(F.struct("period", "n")).alias("by"))
    return both.where(F.col("total") >= LEAST_TOTAL).select("term", F.inline("by"))


def period_density(docs: DataFrame) -> DataFrame:
    """Documents and mean number of different terms, before the vocabulary is pruned."""
    return docs.groupBy("period").agg(long(F.count("*")).alias("docs"), F.round(F.avg(F.size("terms")), 6).alias("density"))


@dataclass
class Counts:
    """Periods in order, the documents of each, a factor for each, and (term, ns, total) with one count for each period."""

    periods: list[str]
    docs: list[int]
    scale: list[float]
    terms: DataFrame


def counted(docs: DataFrame, least_df: int = 40, least_terms: int = 200) -> Counts:
    docs = docs.select("period", "terms")
    found = sorted((r["period"], r["n"]) for r in docs.groupBy("period").agg(F.count("*").alias("n")).collect())
    periods, sizes = [p for p, _ in found], [n for _, n in found]
    by = docs.select(F.explode("terms").alias("term"), "period").groupBy("term")
    ns = F.array(*[F.count_if(F.col("period") == p) for p in periods]) if periods else F.array().cast("array<bigint>")
    table = by.agg(ns.alias("ns"), F.count("*").alias("total")).where(F.col("total") >= LEAST_TOTAL).persist(StorageLevel.MEMORY_AND_DISK)
    return Counts(periods, sizes, scale_factors(table, sizes, least_df, least_terms), table)


def literals(values: list, kind: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def scale_factors(table: DataFrame, sizes: list[int], least_df: int = 40, least_terms: int = 200) -> list[float]:
    """How much each period inflates any share: the median, over frequent terms found in all periods, of a term's share
    divided by its geometric mean over the periods."""
    if len(sizes) < 2:
        return [1.0] * len(sizes)
    shares = F.zip_with("ns", literals(sizes, "double"), lambda n, d: n / d)
    base = table.where((F.col("total") >= least_df) & F.forall("ns", lambda n: n > 0)).select(shares.alias("q"))
    mean = F.exp(F.aggregate("q", F.lit(0.0), lambda s, q: s + F.log(q)) / len(sizes))
    medians = base.select(F.transform("q", lambda q: q / mean).alias("r")).agg(F.count("*").alias("n"), *[F.percentile(F.col("r")[i], F.lit(0.5)).alias(f"m{i}") for i in range(len(sizes))]).first()
    if medians["n"] < least_terms:
        return [1.0] * len(sizes)
    return [max(round(medians[f"m{i}"], 9), 1e-6) for i in range(len(sizes))]


def base_of(ns: Column, sizes: list[int], scale: list[float], k: int) -> tuple[Column, Column, Column]:
    """(mean corrected share of the base, mean count of the base, corrected share now)."""
    last = len(sizes) - 1
    share = lambda i: ns[i] / F.lit(float(max(sizes[i], 1))) / F.lit(scale[i])
    base = range(last - k, last)
    return sum((share(i) for i in base), F.lit(0.0)) / k, sum((ns[i] for i in base), F.lit(0)) / k, share(last)


def changes(c: Counts, rising: bool) -> DataFrame:
    """(term, n, share, base, lift, p, delta) of the terms that rise (or fall) in the last period against up to five before
    it, beyond a level shared out among all terms examined."""
    k = min(BASE_MOST, len(c.periods) - 1)
    if k < BASE_LEAST:
        return c.terms.sparkSession.createDataFrame([], "term string, n bigint, share double, base double, lift double, p double, delta double, total bigint")
    last = len(c.periods) - 1
    rows = c.terms.where(F.col("total") >= SUPPORT)
    examined = rows.agg(F.greatest(F.count("*"), F.lit(1)).alias("examined"))
    base, base_n, now = base_of(F.col("ns"), c.docs, c.scale, k)
    rows = rows.select("term", "total", F.col("ns")[last].alias("n"), (F.col("ns")[last] / F.lit(float(max(c.docs[last], 1)))).alias("share"), base.alias("base"), base_n.alias("base_n"), now.alias("now")).where("base > 0")
    rows = rows.withColumn("lift", F.col("now") / F.col("base"))
    rows = rows.where((F.col("n") >= SUPPORT) & (F.col("lift") >= LIFT)) if rising else rows.where((F.col("base_n") >= SUPPORT) & (F.col("lift") <= 1 / LIFT))
    expected = F.least(F.col("base") * c.scale[last], F.lit(0.999))
    rows = rows.withColumn("p", binomial_tail(F.col("n"), F.lit(c.docs[last]), expected, rising)).join(F.broadcast(examined))
    rows = rows.where(F.col("p") <= ALPHA / F.col("examined"))
    delta = F.col("now") - F.col("base") if rising else F.col("base") - F.col("now")
    return rows.select("term", "n", "share", "base", "lift", "p", delta.alias("delta"), "total")


def specificity(found: DataFrame, table: DataFrame) -> DataFrame:
    """``found`` with ``common``: how many documents the commonest word of the term is in."""
    words = found.select("term", F.explode(F.split("term", " ")).alias("word"))
    totals = table.select(F.col("term").alias("word"), F.col("total").alias("word_total"))
    common = words.join(totals, "word", "left").groupBy("term").agg(F.max(F.coalesce("word_total", F.lit(0))).alias("common"))
    return found.join(common, "term")


def leading(found: DataFrame, docs: DataFrame, order: list[Column], top: int, overlap: float = 0.8) -> DataFrame:
    """The first ``top`` of at most 80 candidates in order, without those whose documents are mostly those of one before.
    Each document says which candidates it holds, and pairs of candidates are counted with partial sums: what comes back
    are at most 80 rows and their 3,240 counts, however many documents there are."""
    ranked = found.orderBy(*order).limit(TOP).collect()
    names = [r["term"] for r in ranked]
    held = docs.select(F.filter("terms", lambda t: t.isin(names)).alias("held")).where(F.size("held") > 0)
    both = held.select("held", F.explode("held").alias("a")).select("a", F.explode("held").alias("b")).where("a <= b").groupBy("a", "b").agg(F.count("*").alias("n"))
    shared = {(r["a"], r["b"]): r["n"] for r in both.collect()}
    kept: list = []
    for r in ranked:
        t = r["term"]
        alike = (shared.get((min(t, o["term"]), max(t, o["term"])), 0) / min(shared[t, t], shared[o["term"], o["term"]]) for o in kept)
        if len(kept) < top and not any(x >= overlap for x in alike):
            kept.append(r)
    schema = StructType([StructField("place", LongType()), *found.schema.fields])
    return docs.sparkSession.createDataFrame([(k + 1, *r) for k, r in enumerate(kept)], schema)


def lens_order() -> list[Column]:
    return [F.desc(F.round("delta", 9)), F.desc(F.col("term").contains(" ")), F.asc("common"), F.asc("term")]


def rising_top(docs: DataFrame, top: int = 12, rising: bool = True) -> DataFrame:
    c = counted(docs)
    return leading(specificity(changes(c, rising), c.terms), docs, lens_order(), top)


# --- weak signals ---

SIGNAL_LEAST, SIGNAL_MOST, GROWTH = 5, 70, 2.0


def weak_signals_raw(docs: DataFrame, c: Counts, window: int = 4, until: str | None = None) -> DataFrame:
    """(term, total, n, growth, delta): little-used terms, never in a title so far, whose corrected share grew through the
    last periods."""
    upto = [i for i, p in enumerate(c.periods) if until is None or p <= until]
    if len(upto) < window + 1:
        return c.terms.sparkSession.createDataFrame([], "term string, total bigint, n bigint, growth double, delta double")
    last = upto[-window:]
    shares = F.array(*[F.col("ns")[i] / F.lit(float(max(c.docs[i], 1))) / F.lit(c.scale[i]) for i in last])
    total = sum((F.col("ns")[i] for i in upto), F.lit(0))
    titled = docs.where(F.col("period") <= c.periods[upto[-1]]).select(F.explode("title_terms").alias("term")).distinct()
    rows = c.terms.select("term", total.alias("total"), F.col("ns")[last[-1]].alias("n"), shares.alias("q")).where(F.col("total").between(SIGNAL_LEAST, SIGNAL_MOST)).join(titled, "term", "left_anti")
    steps = F.size(F.filter(F.zip_with(F.slice("q", 1, window - 1), F.slice("q", 2, window - 1), lambda a, b: b >= a), lambda up: up))
    first, now = F.col("q")[0], F.col("q")[window - 1]
    growth = F.when(first == 0, F.lit(float("inf"))).otherwise(now / F.greatest(first, F.lit(1e-9)))
    rows = rows.withColumn("growth", growth).where((now > 0) & (steps >= window - 2) & (F.col("growth") >= GROWTH))
    return rows.select("term", "total", "n", "growth", (now - first).alias("delta"))


def weak_signals(docs: DataFrame, c: Counts, window: int = 4, until: str | None = None, top: int = 12) -> DataFrame:
    return leading(specificity(weak_signals_raw(docs, c, window, until), c.terms), docs, lens_order(), top)


def backtest(docs: DataFrame, cut: str | None = None, window: int = 4, horizon: int = 3, seed: int = 7, controls: int = 200) -> DataFrame:
    """Whether terms flagged at a past cut reached a title within the next periods, against a control of like terms."""
    c = counted(docs)
    if cut is None:
        cut = c.periods[-4] if len(c.periods) > 6 else c.periods[max(0, len(c.periods) - 2)]
    flagged = weak_signals(docs, c, window, cut, 25).select("term").persist()
    upto = [i for i, p in enumerate(c.periods) if p <= cut]
    later = [p for p in c.periods if p > cut][:horizon]
    titled = docs.select("period", F.explode("title_terms").alias("term"))
    before, after = titled.where(F.col("period") <= cut).select("term").distinct(), titled.where(F.col("period").isin(later)).select("term").distinct().withColumn("hit", F.lit(1))
    total = sum((F.col("ns")[i] for i in upto), F.lit(0))
    like = c.terms.select("term", total.alias("total")).where(F.col("total").between(SIGNAL_LEAST, SIGNAL_MOST)).join(before, "term", "left_anti").join(flagged, "term", "left_anti")
    control = like.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("term")).cast("binary")), "term").limit(controls).select("term")
    rate = lambda d, name: d.join(after, "term", "left").agg(long(F.count("*")).alias(f"{name}_n"), long(F.count("hit")).alias(f"{name}_hits"))
    both = rate(flagged, "flagged").join(F.broadcast(rate(control, "control")))
    share = lambda name: F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_hits") / F.col(f"{name}_n")).otherwise(0.0)
    beats = F.when(share("control") > 0, share("flagged") / share("control") >= 1.3).otherwise(share("flagged") > 0)
    return both.select(F.lit(cut).alias("cut"), "*", share("flagged").alias("flagged_rate"), share("control").alias("control_rate"), beats.alias("beats_control"))


def corpus_health(docs: DataFrame) -> DataFrame:
    """Documents, density and factor of each period, and whether the factor is out of the common."""
    c = counted(docs)
    factors = docs.sparkSession.createDataFrame(list(zip(c.periods, c.scale)), "period string, factor double")
    odd = (F.col("factor") < 0.7) | (F.col("factor") > 1.4)
    return period_density(docs).join(F.broadcast(factors), "period").select("period", "docs", "density", F.round("factor", 6).alias("factor"), odd.alias("warning"))


def examples(docs: DataFrame, term: str, n: int = 5) -> DataFrame:
    return docs.where(F.array_contains("terms", term)).orderBy(F.desc("date"), F.desc("id")).limit(n).select("id", "date")
