"""Text rescue: fragments to sections, issue texts to articles, twins, generic titles, ratios of lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.functions.folds import fold_alnum, letters_with_places
from pressmill.functions.text import collapse, de_hyphenated
from pressmill.operators.reports import long

LEAST_BODY = 600
#: Letters by which a section and an article are the same text.
TWIN = 90


# Sizes of letters in which body, titles and drop caps are set.
BODY_SIZES, TITLE_SIZES, DROP_CAP = (8, 12), (17, 40), 40


def kind_of(font: Column, size: Column, body_fonts: list[str], kicker_fonts: dict[str, tuple[float, float]], furniture: list[str]) -> Column:
    """Kicker, title or body of a fragment by font and size, or null."""
    kind = F.when(F.lit(False), None)
    for name, (low, high) in kicker_fonts.items():
        kind = kind.when((font == name) & size.between(low, high), "antetitulo")
    kind = kind.when(size.between(*TITLE_SIZES) & ~font.isin(furniture), "titular")
    return kind.when(font.isin(body_fonts) & (size.between(*BODY_SIZES) | (size >= DROP_CAP)), "cuerpo").cast("string")


def joined(spans: DataFrame) -> DataFrame:
    """(doc, seq, kind, text) of spans with a kind, each text led by the space that sets it off from the span before it: none
    at the start and after a drop cap; one on a new page or line or after a gap wider than 0.22 of the size."""
    order = Window.partitionBy("doc").orderBy("seq")
    size, page, line, right = (F.lag(c).over(order) for c in ("size", "page", "line", "x1"))
    gap = F.when(size.isNull() | (size >= DROP_CAP), "").when(F.col("page") != page, " ").when(F.col("line") != line, " ").when(F.col("x0") - right > 0.22 * F.col("size"), " ").otherwise("")
    return spans.where("kind is not null").select("doc", "seq", "kind", F.concat(gap, F.col("text")).alias("text"))


def sections(fragments: DataFrame, least: int = LEAST_BODY) -> DataFrame:
    """(doc, place, kicker, title, body) from (doc, seq, kind, text). A title opens a section; titles before any body are one;
    a kicker goes to the next title; body before the first title is left out. Places are counted before short sections
    are dropped."""
    order = Window.partitionBy("doc").orderBy("seq")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = fragments.withColumn("bodies", F.sum(F.when((F.col("kind") == "cuerpo") & (F.col("text") != ""), 1).otherwise(0)).over(upto))
    title = F.col("kind") == "titular"
    last_bodies = F.last(F.when(title, F.col("bodies")), True).over(before)
    opens = title & (last_bodies.isNull() | (last_bodies < F.col("bodies")))
    rows = rows.withColumn("place", F.sum(F.when(opens, 1).otherwise(0)).over(upto)).withColumn("opens", opens)
    # the last kicker since the section before opened
    opened = F.coalesce(F.last(F.when(F.col("opens"), F.col("seq")), True).over(before), F.lit(-1))
    kicker = F.last(F.when(F.col("kind") == "antetitulo", F.struct("seq", "text")), True).over(before)
    rows = rows.withColumn("kicker", F.when(F.col("opens") & (kicker["seq"] > opened), F.trim(kicker["text"])))
    inside = rows.where("place > 0")
    pick = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("seq", "text")))), lambda x: x["text"])
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "\u00ad", ""), r"(?U)(\w)-\s+(?=[a-záéíóúüñ])", "$1"), "[ \t\u00a0]+", " "), r"(?U)^\s+|\s+\z", "")
    out = inside.groupBy("doc", long("place").alias("place")).agg(
        F.coalesce(F.max("kicker"), F.lit("")).alias("kicker"), clean(F.array_join(F.transform(pick("titular"), lambda t: F.trim(t)), " ")).alias("title"), clean(F.array_join(pick("cuerpo"), "")).alias("body")
    )
    return out.where(F.length("body") >= least)


def twins(found: DataFrame, arts: DataFrame) -> DataFrame:
    """(doc, issue_id, place, id): a section and the one article of its issue that begins with the same letters."""
    mark = lambda c: F.substring(fold_alnum(c), 1, TWIN)
    s = found.select("doc", "issue_id", "place", mark(F.col("body")).alias("mark")).where(F.length("mark") == TWIN)
    a = arts.where("issue_id is not null").select("issue_id", "id", mark(F.coalesce("body", F.lit(""))).alias("mark"))
    n = F.count("*").over(Window.partitionBy("doc", "place"))
    return s.join(a, ["issue_id", "mark"]).withColumn("n", n).where("n = 1").select("doc", "issue_id", "place", "id")


# How titles name an issue, and what may follow where they say nothing else.
ISSUE_PREFIX = r"(?iu)^\s*#?\s*(?:ispe|informe semanal(?: de pol[íi]tica exterior)?)\s*n?[.º°]?\s*\d*"
ONLY_DATE = r"(?iu)^[\s.:·,\-–]*(?:\d{1,2}\s*)?(?:de\s+)?(?:ene|feb|mar|abr|may|jun|jul|ago|sep|set|oct|nov|dic)[a-z]*\.?\s*(?:de\s+)?\d{0,4}[\s.]*\z"


def issue_title(title: Column, prefix: str = ISSUE_PREFIX, date: str = ONLY_DATE) -> Column:
    """Whether a title is only that of its issue: the prefix, alone or with a date."""
    rest = F.regexp_replace(title, prefix, "")
    return title.rlike(prefix) & (rest.rlike(r"^[ .:·,\-–]*\z") | rest.rlike(date))


# Letters of a title that are looked for where it isn't found in full, and the least that a title has.
CUTS, LEAST_TITLE = (40, 30, 22), 10
#: Letters of a text that can be cut, and of a part that can be better than a body.
LEAST_TEXT, LEAST_PART = 1200, 400


def located(text: str, titles: list[str]) -> list[int | None]:
    """Where each folded title begins in a folded text: in full, or its first 40, 30 or 22 letters; None if nowhere or if it
    has fewer than 10 letters. All of them and their beginnings are one automaton, which reads the text once."""
    import ahocorasick

    wanted = [[t, *(t[:k] for k in CUTS if k <= len(t))] if len(t) >= LEAST_TITLE else [] for t in titles]
    automaton = ahocorasick.Automaton()
    for w in {w for ws in wanted for w in ws}:
        automaton.add_word(w, w)
    first: dict[str, int] = {}
    if len(automaton):
        automaton.make_automaton()
        for end, w in automaton.iter(text):
            first.setdefault(w, end + 1 - len(w))
    return [next((first[w] for w in ws if w in first), None) for ws in wanted]


def cuts(text: str, titles: list[str]) -> list[tuple[int, int, int]]:
    """(which title, start, end) of a text dealt out to its titles: each from where it begins to where the next found begins; all
    of it to an only title. Of titles that begin at one place the last has the part."""
    if len(titles) == 1:
        return [(0, 0, len(text))]
    letters, places = letters_with_places(text)
    found = [at for at in located(letters, [letters_with_places((t or "").strip())[0] for t in titles])]
    starts = sorted((places[at], k) for k, at in enumerate(found) if at is not None)
    return [(k, start, end) for (start, k), end in zip(starts, [*(s for s, _ in starts[1:]), len(text)])]


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for issue, text, pieces in zip(*(c.to_pylist() for c in batch.columns)):
            for k, start, end in cuts(text, [p["title"] for p in pieces]):
                part = text[start:end].strip()
                rows.append((issue, pieces[k]["id"], start, len(part), part))
        columns = list(zip(*rows)) if rows else [[]] * 5
        names, kinds = ("issue_id", "id", "start", "chars", "part"), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=list(names))


def split_issue(texts: DataFrame, arts: DataFrame) -> DataFrame:
    """(issue_id, id, start, chars, part) of the text of an issue dealt out to its articles. Titles come to the text, which stays
    one row; letters are folded with their places kept, so a cut falls where the title begins."""
    titles = arts.groupBy("issue_id").agg(F.array_sort(F.collect_list(F.struct(F.col("id").cast("long").alias("id"), "title"))).alias("pieces"))
    both = texts.select(F.col("issue_id").cast("long"), "text").where("text is not null").join(titles, "issue_id")
    return both.mapInArrow(_dealt, "issue_id long, id long, start long, chars long, part string")


def readable(texts: DataFrame, least: int = LEAST_TEXT) -> DataFrame:
    """Texts of issues without those too short to be a text, such as of scanned pages: those are skipped whole."""
    return texts.where(F.length("text") >= least)


def rescued(texts: DataFrame, arts: DataFrame) -> DataFrame:
    """(issue_id, id, chars, is_full, part) of what an issue's text has better for its partial articles; a text under 1,200
    letters is skipped, a part counts if it is longer than the body there and than 400 letters."""
    parts = split_issue(readable(texts), arts)
    return parts.join(accepted(parts.select("id", "chars"), arts).select("id", "is_full"), "id").select("issue_id", "id", "chars", "is_full", "part")


def rescue_states(texts: DataFrame, arts: DataFrame) -> DataFrame:
    """(issue_id, status, tried, better): what became of each issue: no text, or how many partial articles were tried and
    how many have a better body now."""
    found = rescued(texts, arts).groupBy("issue_id").agg(long(F.count("*")).alias("better"))
    tried = arts.groupBy("issue_id").agg(long(F.count_if(~F.col("is_full"))).alias("tried"))
    rows = texts.select("issue_id", (F.length("text") >= LEAST_TEXT).alias("readable")).join(tried, "issue_id").join(found, "issue_id", "left")
    status = F.when(~F.col("readable"), "sin-texto").otherwise("ok")
    return rows.select("issue_id", status.alias("status"), F.when(F.col("readable"), F.col("tried")).otherwise(F.lit(0)).cast("bigint").alias("tried"), F.coalesce("better", F.lit(0)).cast("bigint").alias("better"))


def accepted(parts: DataFrame, arts: DataFrame) -> DataFrame:
    """(id, chars, is_full) of parts that are better than what a partial article has."""
    old = arts.where(~F.col("is_full")).select("id", F.length(F.coalesce("body", F.lit(""))).alias("old"))
    rows = parts.join(old, "id").where(F.col("chars") > F.greatest("old", F.lit(LEAST_PART)))
    return rows.select("id", "chars", (F.col("chars") >= LEAST_TEXT).alias("is_full"))


def length_ratio(web: DataFrame, other: DataFrame) -> DataFrame:
    """(issue_id, web_chars, pdf_chars, ratio, verdict) of two sources of an issue."""
    both = web.join(other, "issue_id")
    ratio = F.col("pdf_chars") / F.greatest("web_chars", F.lit(1))
    return both.select("issue_id", "web_chars", "pdf_chars", F.round(ratio, 6).alias("ratio"), F.when(ratio < 1.6, "same").when(ratio < 2.5, "some missing").otherwise("much missing").alias("verdict"))


def dehyphenated_text(text: Column) -> Column:
    return collapse(de_hyphenated(text))
