"""I-Match document fingerprints, with DataFrame functions only.

Document frequencies of all terms are counted over the whole corpus. The lexicon holds the terms within a band of
inverse document frequency; since the frequencies of all terms add up to (documents x mean distinct terms), it has at
most (mean distinct terms / least share) terms however large the corpus is. It is broadcast when it is within a checked
size, joined by shuffle when not. Of a text the distinct terms in the lexicon are sorted; all of them are hashed, and those in each of 66
randomised subsets of the lexicon (4 draws at the rate 1/2, 2 at 1/4, 12 at each of 1/32, 1/128, 1/256, 1/512 and 1/1024). The fingerprint is these
67 hashes in hexadecimal, 000000 where a subset holds no term of the text. Two fingerprints are as like as the share of
subsets, with a term in either, that have equal hashes.

``neighbours`` finds the next document by id without sorting all rows in one task: ids are dealt over ranges of about
equal size, and the first document of a range is also sent to the range before it. The fingerprints are then made in
that same partitioning, so the texts are shuffled once.

Defined results: null text counts as empty; a text of fewer than 16 terms in the lexicon is filled up to 16 with its other terms;
in a corpus without a lexicon (no term within the band) a text keeps all its terms; so only a text without any term has an
empty fingerprint;
two texts without any term are as like as 1 if equal, else 0; null ids come first; rows with the same id follow each
other; one document is its own next; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.llm.common import staged, table, texts

LEAST_SHARE, MOST_SHARE = 0.001, 0.2
FEW_TERMS = 16
#: Rows of a lexicon that may be broadcast (16 bytes each).
BROADCAST_ROWS = 500_000
#: Documents of a range, and quantiles of the ids at most; beyond that each stretch between two is cut into equal parts.
RANGE_ROWS, RANGES = 200, 4096
#: First rows of ranges that may be broadcast.
FIRSTS = 200_000
#: A subset keeps one term in 2 to the power of this; each rate is drawn 12 times.
RATES = (5, 7, 8, 9, 10)
WORDS = r"[\s\p{Punct}]+"


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case words."""
    words = F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """The terms (as hashes) of between ``least`` and ``most`` of the documents, and of two documents at least."""
    counted = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = docs.count()
    return counted.where((F.col("df") >= max(2.0, least * n)) & (F.col("df") <= max(2.0, most * n))).select("term")


def subset_hashes(sets: DataFrame) -> DataFrame:
    """``hashes`` from ``found``, the sorted terms: one number for all of them and for each randomised subset, 0 where it is
    empty. Twelve draws (ten bits each of the term and of its hash) are thinned from rate to rate, so most terms are looked at
    once a draw; the dense subsets use the four bits of each that are left."""
    others = [c for c in sets.columns if c != "found"]

    def thin(values: Column, shift: Column, bits: int) -> Column:
        return F.filter(values, lambda x: F.call_function("shiftrightunsigned", x, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) == 0)

    shifts = F.array(*[F.lit(10 * g) for g in range(6)])
    both = sets.withColumn("again", F.transform("found", lambda x: F.xxhash64(x)))
    drawn = F.concat(F.transform(shifts, lambda s: thin(F.col("found"), s, RATES[0])), F.transform(shifts, lambda s: thin(F.col("again"), s, RATES[0])))
    dense = [F.array(F.col("found")), *[F.array(thin(F.col("found"), F.lit(60 + g), 1)) for g in range(4)], *[F.array(thin(F.col("again"), F.lit(60 + g), 2)) for g in (0, 2)]]
    rows = both.select(*others, F.concat(*dense).alias("whole"), drawn.alias("r0"))

    def thinner(bits: int):
        return lambda v, i: thin(v, (i % 6) * 10, bits)

    for k, bits in enumerate(RATES[1:]):
        rows = rows.withColumn(f"r{k + 1}", F.transform(f"r{k}", thinner(bits)))
    hashed = [F.transform(c, lambda v: F.when(F.size(v) == 0, F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(v), F.lit(16777215)) + 1)) for c in ("whole", *(f"r{k}" for k in range(len(RATES))))]
    return rows.select(*others, F.concat(*hashed).alias("hashes"))


def fingerprint(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(a: Column, b: Column, equal: Column) -> Column:
    same = F.filter(F.zip_with(a, b, lambda x, y: F.when((x != 0) | (y != 0), (x == y).cast("double"))), lambda x: x.isNotNull())
    return F.when(F.size(same) == 0, equal.cast("double")).otherwise(F.aggregate(same, F.lit(0.0), lambda s, x: s + x) / F.size(same))


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, ord (null ids first), text, range_id and helper: each row in its range of ids, and the first row of each range
    once more, as a helper, at the end of the range before it (the very first at the end of the last)."""
    docs = docs.withColumn("ord", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = docs.count()
    ranges = max(1, min(RANGES, n // RANGE_ROWS))
    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    bounds = sorted(set(docs.agg(F.percentile_approx("ord", shares, 20 * RANGES).alias("b")).first()["b"] or [])) if shares and n else []
    ids, step = F.col("ord"), 64
    if bounds:
        array = F.lit(bounds).cast("array<bigint>")
        top = F.lit(bounds[step - 1 :: step]).cast("array<bigint>")
        whole = F.size(F.filter(top, lambda b: b < ids)) * step
        bucket = whole + F.size(F.filter(F.slice(array, whole + 1, F.lit(step)), lambda b: b < ids))
    else:
        bucket = F.lit(0)
    docs = docs.withColumn("coarse", bucket.cast("int"))
    parts = max(1, n // (RANGE_ROWS * RANGES))
    ends = [-(1 << 63), *bounds, (1 << 63) - 1]
    low, high = (F.lit(ends).cast("array<bigint>")[F.col("coarse") + k].cast("double") for k in (0, 1))
    part = F.least(F.floor((ids.cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * parts), F.lit(parts - 1)) if parts > 1 else F.lit(0)
    docs = docs.withColumn("range_id", F.col("coarse").cast("long") * parts + part.cast("long"))
    # the first row of each range goes to the range before it, which may lie in the stretch before; the first of all to the last
    firsts = docs.groupBy("coarse", "range_id").agg(F.min("ord").alias("ord"))
    last = dict(firsts.groupBy("coarse").agg(F.max("range_id")).collect())  # a row for each quantile
    order = sorted(last)
    before = {c: last[order[i - 1]] for i, c in enumerate(order)}
    entry = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair]), F.col("coarse").cast("long")) if before else F.lit(None).cast("long")
    ahead = firsts.select("ord", F.coalesce(F.lag("range_id").over(Window.partitionBy("coarse").orderBy("range_id")), entry).alias("to_range"))
    if len(ends) * parts <= FIRSTS:
        ahead = F.broadcast(ahead)
    both = docs.join(ahead, "ord", "left")
    places = F.when(F.col("to_range").isNull(), F.array(F.struct(F.col("range_id").alias("r"), F.lit(False).alias("h")))).otherwise(
        F.array(F.struct(F.col("range_id").alias("r"), F.lit(False).alias("h")), F.struct(F.col("to_range").alias("r"), F.lit(True).alias("h")))
    )
    placed = both.select("doc_id", "ord", "text", F.explode(places).alias("p"))
    return placed.select("doc_id", "ord", "text", F.col("p.r").alias("range_id"), F.col("p.h").alias("helper"))


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (its last half replaced by the start of the next document), and how like they and the next document's are."""
    docs = texts(docs, id_col, text_col)
    words = staged(lexicon(docs), "lexicon")
    size = words.count()
    words = words.withColumn("known", F.lit(True))
    if size <= BROADCAST_ROWS:
        words = F.broadcast(words)
    order = Window.partitionBy("range_id").orderBy("helper", "ord", F.xxhash64("text"))
    rows = in_ranges(docs).withColumn("pos", F.row_number().over(order)).withColumn("after", F.lead("text").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.coalesce(F.substring("after", F.lit(1), half), F.lit("")))
    key = ["range_id", "pos", "helper", "doc_id", "n_chars", "sha", "edited_sha256"]
    rows = rows.select("range_id", "pos", "helper", "doc_id", F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("sha", F.sha2("text", 256)).withColumn("edited_sha256", F.sha2("edited", 256))
    sides = rows.select(*key, F.posexplode(F.array(terms(F.col("text")), terms(F.col("edited")))).alias("side", "terms"))
    found = sides.select(*key, "side", F.explode_outer("terms").alias("term")).join(words, "term", "left")
    inside, outside = F.when(F.col("known"), F.col("term")), F.when(F.col("known").isNull(), F.col("term"))
    sets = found.groupBy(*key, "side").agg(F.collect_list(inside).alias("inside"), F.collect_list(outside).alias("outside"))
    # a text of few terms of the lexicon is filled up from its others, least hash first: one term more changes one term.
    # Without a lexicon no text, edited or not, is near that line, and 16 of many terms would tell less than all of them
    rank = F.transform("outside", lambda t: F.struct(F.xxhash64(t).alias("h"), t.alias("t")))
    fill = F.transform(F.slice(F.array_sort(rank), 1, F.greatest(FEW_TERMS - F.size("inside"), F.lit(0))), lambda x: x["t"])
    kept = F.when(F.size("inside") < FEW_TERMS, F.concat("inside", fill)).otherwise(F.col("inside")) if size else F.col("outside")
    sets = sets.select(*key, "side", F.sort_array(kept).alias("found"))
    hashed = subset_hashes(sets)
    pairs = hashed.groupBy(*key).agg(F.max(F.when(F.col("side") == 0, F.col("hashes"))).alias("own"), F.max(F.when(F.col("side") == 1, F.col("hashes"))).alias("edited"))
    by_place = Window.partitionBy("range_id").orderBy("pos")
    pairs = pairs.withColumn("next", F.lead("own").over(by_place)).withColumn("next_sha", F.lead("sha").over(by_place))
    return pairs.where(~F.col("helper")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited"), F.col("sha") == F.col("edited_sha256")).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), F.col("sha") == F.col("next_sha")).alias("near_next"),
    )


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
