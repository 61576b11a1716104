"""Search over articles: postings, a query language evaluated as set algebra, rank, headlines, paging and grouping; and the
views of an issue and of an article. ``operators.index`` keeps the postings as a stored index.

A posting is a stem in a field of a piece, with its positions there. A query reads the postings of its stems alone; they
meet once by piece, where phrases, exclusions and alternatives are one expression over what the piece holds. Only a query
that exclusions alone can satisfy looks at all pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import and_, or_

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pressmill.functions.stemmer import stem
from pressmill.operators import ordered
from pressmill.operators.reports import long, pieces

# Weights of title, subtitle and body.
WEIGHTS = {"title": 1.0, "subtitle": 0.4, "body": 0.2}
# Words of a fragment of a headline at least and at most, and fragments.
FEW_WORDS, MANY_WORDS, FRAGMENTS = 15, 30, 2
POSTING = "stem string, id long, field string, positions array<int>"


def _posted(wanted: frozenset[str] | None):
    schema = pa.schema([("stem", pa.string()), ("id", pa.int64()), ("field", pa.string()), ("positions", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(1 << 18)(stem)
        for batch in batches:
            rows: list[tuple] = []
            for k, piece in enumerate(batch.column(0).to_pylist()):
                for column, field in enumerate(WEIGHTS, 1):
                    places: dict[str, list[int]] = {}
                    for at, word in enumerate(re.findall(r"\w+", (batch.column(column)[k].as_py() or "").lower())):
                        s = known(word)
                        if wanted is None or s in wanted:
                            places.setdefault(s, []).append(at)
                    rows += [(s, piece, field, p) for s, p in places.items()]
                if len(rows) > 50_000 or k == batch.num_rows - 1 and rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []

    return run


def postings(arts: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """(stem, id, field, positions) of title, subtitle and body, of all stems or of those wanted. A text is read once and its
    words are stemmed where it lies; nothing is shuffled."""
    return arts.select(F.col("id").cast("long"), *WEIGHTS).mapInArrow(_posted(None if wanted is None else frozenset(wanted)), POSTING)


def parse_query(text: str) -> list[list[tuple[bool, list[str]]]]:
    """Alternatives ('or') of conditions: (wanted, stems next to each other); '"…"' is a phrase, '-' excludes."""
    found: list[list[tuple[bool, list[str]]]] = [[]]
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', text.lower()):
        if word == "or" and not minus:
            if found[-1]:
                found.append([])
            continue
        parts = [stem(w) for w in re.findall(r"\w+", phrase or word)]
        if parts:
            found[-1].append((not minus, parts))
    return [a for a in found if a]


def query_stems(query: str, wanted_only: bool = False) -> list[str]:
    """The stems that a query names, wanted or not."""
    return sorted({x for a in parse_query(query) for yes, parts in a for x in parts if yes or not wanted_only})


def holds(parts: list[str]) -> Column:
    """Whether a piece with ``found`` (stem and field to positions) has the stems next to each other in a field."""
    def at(field: str, part: str) -> Column:
        return F.coalesce(F.col("found")[f"{field} {part}"], F.array().cast("array<int>"))

    def in_field(field: str) -> Column:
        first, rest = at(field, parts[0]), list(enumerate(parts[1:], 1))
        return F.exists(first, lambda p: reduce(and_, [F.array_contains(at(field, part), (p + k).cast("int")) for k, part in rest])) if rest else F.size(first) > 0

    return reduce(or_, map(in_field, WEIGHTS))


def score(stems: list[str]) -> Column:
    """For each stem and field that has it: the field's weight, more of it the more often the stem is there."""
    def part(field: str, weight: float, s: str) -> Column:
        n = F.size(F.col("found")[f"{field} {s}"])
        return F.when(n > 0, weight * (1 - 1 / (1 + F.log2(1 + n)))).otherwise(0.0)

    return F.round(sum((part(field, weight, s) for s in stems for field, weight in WEIGHTS.items()), F.lit(0.0)), 9)


def ranked(index: DataFrame, query: str, ids: DataFrame | None = None) -> DataFrame:
    """(id, rank) of what a query matches; rank is 0 where a piece has none of the wanted stems. ``ids`` are all pieces; where
    they aren't given, those that the index knows. An empty query matches nothing."""
    alternatives, stems = parse_query(query), query_stems(query)
    if not alternatives:
        return index.select("id", F.lit(0.0).alias("rank")).limit(0)
    rows = index.where(F.col("stem").isin(stems))
    key = F.concat("field", F.lit(" "), "stem")
    found = rows.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct(key, "positions"))).alias("found"))
    if any(not yes for a in alternatives for yes, _ in a) and any(all(not yes for yes, _ in a) for a in alternatives):
        everything = (index if ids is None else ids).select("id").distinct()
        found = everything.join(found, "id", "left").withColumn("found", F.coalesce("found", F.create_map().cast("map<string,array<int>>")))
    elif ids is not None:
        found = found.join(ids.select("id"), "id", "left_semi")
    matched = reduce(or_, [reduce(and_, [holds(parts) if yes else ~holds(parts) for yes, parts in a]) for a in alternatives])
    return found.where(matched).select("id", score(query_stems(query, True)).alias("rank"))


def matches(index: DataFrame, query: str, ids: DataFrame | None = None) -> DataFrame:
    """(id) of what a query matches."""
    return ranked(index, query, ids).select("id")


def fragments(hits: list[int], n: int, few: int = FEW_WORDS, many: int = MANY_WORDS, most: int = FRAGMENTS) -> list[tuple[int, int]]:
    """Stretches of a text of n words, from the first to after the last word, in order: each begins at a hit and covers as
    many hits as ``many`` words can, the best first, none over another; it ends after its last hit, ``few`` words at least."""
    chosen: list[tuple[int, int]] = []
    for _ in range(most):
        best = None
        right = 0
        for left, start in enumerate(hits):
            right = max(right, left)
            while right + 1 < len(hits) and hits[right + 1] < start + many:
                right += 1
            end = min(n, max(hits[right] + 1, start + few))
            if all(end <= a or b <= start for a, b in chosen) and (best is None or right - left > best[0]):
                best = right - left, start, end
        if best is None:
            break
        chosen.append(best[1:])
    return sorted(chosen) or [(0, min(n, few))]


def headline(body: str | None, stems: frozenset[str]) -> str | None:
    """The best fragments of a text, words that have one of the stems marked; its beginning where none has."""
    if body is None:
        return None
    words = body.split()
    marked = [any(stem(w) in stems for w in re.findall(r"\w+", word)) for word in words]
    spans = fragments([k for k, m in enumerate(marked) if m], len(words))
    return " … ".join(" ".join(f"<mark>{words[k]}</mark>" if marked[k] else words[k] for k in range(a, b)) for a, b in spans)


def snippet(body: Column, stems: list[str]) -> Column:
    """``headline`` of each row; for the few rows of a page."""
    wanted = frozenset(stems)

    def cut(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: headline(b, wanted), na_action="ignore")

    return F.pandas_udf(cut, StringType())(body)


def listed(hits: DataFrame, number: int = 1, size: int = 25, by_rank: bool = True) -> DataFrame:
    """One page of hits with the place of each and its group: rank first or newest first."""
    order = ([F.desc("rank")] if by_rank else []) + [F.desc_nulls_last("published_date"), F.desc("id")]
    shown = page(hits, number, size, order)
    return with_groups(shown.withColumn("pos", F.row_number().over(Window.orderBy(*order))))  # of one page


def results(arts: DataFrame, query: str, number: int = 1, size: int = 25, by_rank: bool = True, **limits) -> DataFrame:
    """One page of a search over articles that have no stored index: filters, matches, order, groups, snippets."""
    rows = filtered(arts, **limits)
    hits = ranked(postings(rows, query_stems(query)), query, rows)
    shown = listed(rows.select("id", "pub_slug", "issue_id", "published_date", "title").join(hits, "id"), number, size, by_rank)
    return shown.join(rows.select("id", snippet(F.col("body"), query_stems(query, True)).alias("snippet")), "id").select("pos", "island", "id", "pub_slug", "issue_id", "published_date", "title", "rank", "snippet").orderBy("pos")


def limited(rows: DataFrame, pub: str | None = None, year: int | None = None, ids: DataFrame | None = None, since: int | None = None) -> DataFrame:
    if pub:
        rows = rows.where(F.col("pub_slug") == pub)
    if year:
        rows = rows.where(F.year("published_date") == year)
    if since:
        rows = rows.where(F.year("published_date") >= since)
    return rows if ids is None else rows.join(ids, "id", "left_semi")


def filtered(arts: DataFrame, pub: str | None = None, year: int | None = None, ids: DataFrame | None = None, since: int | None = None) -> DataFrame:
    return limited(pieces(arts), pub, year, ids, since)


def page(rows: DataFrame, number: int, size: int = 25, order: list[Column] | None = None) -> DataFrame:
    """One page, newest first unless another order is given."""
    order = order or [F.desc_nulls_last("published_date"), F.desc("id")]
    return rows.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def page_count(rows: DataFrame, size: int = 25) -> DataFrame:
    return rows.agg(long(F.count("*")).alias("total")).select("total", F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("bigint").alias("pages"))


def lead(arts: DataFrame, n: int) -> Column:
    return F.coalesce("subtitle", F.substring("body", 1, n))


def with_groups(shown: DataFrame) -> DataFrame:
    """``shown``, a page with places ``pos``, with the number ``island`` of each one's group: results of one issue that follow
    each other; a result without issue is its own."""
    order = Window.orderBy("pos")
    same = F.col("issue_id").isNotNull() & (F.lag("issue_id").over(order) == F.col("issue_id")) & (F.lag("pub_slug").over(order) == F.col("pub_slug"))
    return shown.withColumn("island", long(F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(order)))


def grouped(results: DataFrame) -> DataFrame:
    """The groups of ``with_groups``, with their ids in order. ``results`` is a page: a few dozen rows."""
    inside = F.array_sort(F.collect_list(F.struct("pos", "id")))
    rows = with_groups(results).groupBy("island")
    return rows.agg(F.min_by("pub_slug", "pos").alias("pub_slug"), F.min_by("issue_id", "pos").alias("issue_id"), F.min_by("published_date", "pos").alias("published_date"), F.transform(inside, lambda x: x["id"]).alias("ids"))


def grouped_all(arts: DataFrame, parts: int | None = None) -> DataFrame:
    """Groups as of ``grouped`` over all pieces, newest first, by a scan in ranges."""
    newest = F.struct(F.col("published_date").isNull(), -F.datediff("published_date", F.lit("1970-01-01")), -F.col("id"))
    rows = ordered.in_ranges(pieces(arts).select("id", "pub_slug", "issue_id", "published_date"), newest, parts)
    rows = ordered.with_neighbours(rows, F.struct("issue_id", "pub_slug"), before="before")
    same = F.coalesce(F.col("issue_id").isNotNull() & (F.col("before.issue_id") == F.col("issue_id")) & (F.col("before.pub_slug") == F.col("pub_slug")), F.lit(False))
    rows = ordered.with_running_sum(rows, F.when(same, 0).otherwise(1), "island")
    inside = F.array_sort(F.collect_list(F.struct(F.col(ordered.KEY).alias("key"), "id")))
    first = lambda c: F.min_by(c, ordered.KEY).alias(c)
    return rows.groupBy(long("island").alias("island")).agg(first("pub_slug"), first("issue_id"), first("published_date"), F.transform(inside, lambda x: x["id"]).alias("ids"))


def neighbours(arts: DataFrame, parts: int | None = None) -> DataFrame:
    """(id, previous_id, next_id) within a publication by date and id, by a scan in ranges; undated pieces have none and are
    none."""
    rows = pieces(arts).where("published_date is not null").select("id", "pub_slug", "published_date")
    rows = ordered.in_ranges(rows, F.struct("pub_slug", "published_date", "id"), parts)
    rows = ordered.with_neighbours(rows, F.struct("id", "pub_slug"), "before", "after")
    own = lambda c: F.when(F.col(f"{c}.pub_slug") == F.col("pub_slug"), F.col(f"{c}.id"))
    return rows.select("id", own("before").alias("previous_id"), own("after").alias("next_id"))


def siblings(arts: DataFrame) -> DataFrame:
    """(id, sibling_id): other pieces of the same issue."""
    a = pieces(arts).where("issue_id is not null").select("id", "issue_id", "pub_slug")
    b = a.select(F.col("id").alias("sibling_id"), "issue_id", "pub_slug")
    return a.join(b, ["issue_id", "pub_slug"]).where("id <> sibling_id").select("id", "sibling_id")


def latest_issues(arts: DataFrame, n: int = 3, include_covers: bool = False) -> DataFrame:
    """The newest issues that have pieces: (place, issue_id, published_date, pieces)."""
    rows = (arts if include_covers else pieces(arts)).where("issue_id is not null and published_date is not null")
    found = rows.groupBy("issue_id").agg(F.max("published_date").alias("published_date"), long(F.count("*")).alias("pieces")).orderBy(F.desc("published_date"), F.desc("issue_id")).limit(n)
    return found.select(F.row_number().over(Window.orderBy(F.desc("published_date"), F.desc("issue_id"))).cast("bigint").alias("place"), "*")


def front_page(arts: DataFrame, chars: int = 420) -> DataFrame:
    """The pieces of the newest issue: the longest first, as feature, the others by id, each with a lead."""
    newest = latest_issues(arts, 1).select("issue_id")
    rows = pieces(arts).join(F.broadcast(newest), "issue_id", "left_semi")
    longest = F.row_number().over(Window.orderBy(F.length("body").desc_nulls_last(), "id"))
    rows = rows.withColumn("place", longest)
    return rows.select("id", (F.col("place") == 1).alias("feature"), lead(arts, chars).alias("lead"), long(F.length("body")).alias("chars"))


def context(arts: DataFrame) -> DataFrame:
    rows = pieces(arts)
    return rows.agg(long(F.count("*")).alias("pieces"), long(F.countDistinct("issue_id")).alias("issues"), F.min("published_date").alias("first_date"), F.max("published_date").alias("last_date"))


def paragraphs(body: str = "body") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(F.col(body), F.lit("")), "\n\n"), lambda p: F.trim(p)), lambda p: F.length(p) > 0)
