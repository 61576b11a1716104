"""Near-duplicate classes by ProbMinHash.

A text is a bag of five-word shingles (ASCII white space, ASCII case folded; a shorter text is one shingle), weighted by
how often each occurs. Every shingle is a Poisson process with its share of the weight as rate; its arrivals fall on
random registers, a register keeps the shingle that arrives first, and a process ends once it is later than all
registers, so that registers of two texts agree with the probability Jaccard similarity of their bags. Rows of the same
words have one key. Bands of eight of 256 registers put texts in buckets (a pair of similarity 0.8 meets with probability
0.997, of 0.5 with 0.12). Only texts that meet another get 1,024 further registers, of which one bit each is kept; pairs
that differ in more of these bits than three standard deviations allow a pair of similarity 0.8 (one in 700 of those is
lost, fewer above) are passed over before any text is joined. The rest are verified by the exact probability Jaccard
similarity. First each bucket is compared with one of its members, then with four more, which
unites nearly all; what is still outside its bucket's largest class is then compared with members of other classes. Links
make classes (least label with pointer jumping, each round written to the shared folder).

Defined results: null counts as empty; texts without words are one class; a class is named after its smallest doc_id
(null ids last); exactly one row of a class is kept; texts are taken whole; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import discard, kept_rows, shuffled, small_batches, staged, table, texts

SHINGLE = 5
REGISTERS, BAND = 256, 8
THRESHOLD = 0.8
#: Registers behind the one-bit signature of texts that meet others, 64 to a column.
BITS = 1024
WORDS = [f"s{k}" for k in range(BITS // 64)]
#: Ids of texts to fetch that are broadcast; more are joined by a shuffle.
FETCHED = 400_000
#: Edges in a file of a table of links.
EDGES = 200_000
#: Members drawn from each bucket in each of the comparisons before those of its smaller classes with the rest.
DRAWN = (1, 4)
CHUNK = 2 << 20
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words:
    """64-bit hashes of the words of many texts at once, from prefix sums of a polynomial."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def __call__(self, folded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts in order, and the number of words of each text."""
        data = b" " + b" ".join(folded) + b" "
        b = np.frombuffer(data, np.uint8)
        space = (b == 32) | ((b >= 9) & (b <= 13))
        n = len(b)
        if len(self.powers) < n:
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, ODD[0], np.uint64)])
            self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(ODD[0], -1, 1 << 64), np.uint64)])
        edge = np.diff(space.view(np.int8))
        first, last = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1)
        total = np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.powers[:n])
        h = mixed((total[last] - total[first - 1]) * self.inverses[first])
        ends = np.cumsum([len(t) + 1 for t in folded])
        return h, np.diff(np.searchsorted(first, ends, "right"), prepend=0)


def shingles(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of the distinct shingles of each text, by text and shingle."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if not len(words):
        return owner, words, owner
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(words))  # words from here to the text's end
    h = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        there = np.zeros(len(words), np.uint64)
        there[: max(0, len(words) - k)] = words[k:] * np.uint64(ODD[k])
        h += np.where(left > k, there, np.uint64(0))
    whole = sizes[owner]
    use = (left >= SHINGLE) | ((whole < SHINGLE) & (left == whole))
    owner, h = owner[use], mixed(h[use])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.r_[at, len(h)])


def registers(owner: np.ndarray, element: np.ndarray, count: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """For each text the shingles that reach each of the m registers first (0 where there are none)."""
    total = np.bincount(owner, count, n)
    rate = count / total[owner]
    best, winner = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    at, clock = np.arange(len(element)), np.zeros(len(element))
    done, block = 0, 1
    while len(at):
        # the next ``block`` arrivals of every process still running
        step = np.arange(done, done + block, dtype=np.uint64) * np.uint64(ODD[1]) + np.uint64(ODD[2])
        r = mixed(element[at][:, None] ^ step[None, :])
        gap = -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[at][:, None]
        time = clock[:, None] + np.cumsum(gap, 1)
        place = owner[at][:, None] * m + (mixed(r + np.uint64(ODD[3])) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, place.ravel(), time.ravel())
        hit = best[place] == time
        winner[place[hit]] = np.broadcast_to(element[at][:, None], place.shape)[hit]
        clock = time[:, -1]
        last = best.reshape(n, m).max(1)
        go = clock < last[owner[at]]
        at, clock = at[go], clock[go]
        done += block
        block = min(64, max(1, done)) if len(at) * done < 1 << 20 else 1
    return winner.reshape(n, m)


def bands(winner: np.ndarray) -> np.ndarray:
    """One key for each band of each text."""
    n, m = winner.shape
    parts = winner.reshape(n, m // BAND, BAND)
    h = np.zeros((n, m // BAND), np.uint64) + np.arange(m // BAND, dtype=np.uint64) * np.uint64(ODD[4])
    for k in range(BAND):
        h = mixed((h ^ parts[:, :, k]) * np.uint64(ODD[k % len(ODD)]))
    return h.astype(np.int64)


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Folded texts of a batch in runs of bounded size, with the row of the first."""
    start, part, size = 0, [], 0
    for i, value in enumerate(batch.column(column)):
        part.append(value.as_buffer().to_pybytes().translate(FOLD))
        size += len(part[-1])
        if size >= CHUNK:
            yield start, part
            start, part, size = i + 1, [], 0
    if part:
        yield start, part


def word_key(folded: bytes) -> bytes:
    """What two texts of the same words have in common."""
    return hashlib.sha256(b" ".join(folded.split())).digest()[:16]


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (uid, doc_id, sha, key, bands); of a key seen before in the partition without bands."""
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.binary()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])
    uid, hashed, seen = (TaskContext.get().partitionId() << 36) if TaskContext.get() else 0, Words(), set()
    for batch in batches:
        for start, part in chunks(batch, 1):
            keys = [word_key(t) for t in part]
            new = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
            if len(seen) > 1 << 18:
                seen.clear()
            band_lists = [None] * len(part)
            if new:
                words, sizes = hashed([part[i] for i in new])
                for i, b, size in zip(new, bands(registers(*shingles(words, sizes), len(new))), sizes):
                    band_lists[i] = b if size else []
            ids = batch.column(0).slice(start, len(part))
            shas = [hashlib.sha256(batch.column(1)[i].as_buffer()).digest() for i in range(start, start + len(part))]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + len(part))), ids, pa.array(shas, pa.binary()), pa.array(keys, pa.binary()), pa.array(band_lists, schema.field(4).type)], schema=schema)
            uid += len(part)


def signatures(winner: np.ndarray) -> np.ndarray:
    """One bit of each register, 64 to a number."""
    bits = (mixed(winner ^ np.uint64(ODD[4])) >> np.uint64(40)).astype(np.uint8) & 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (key, folded text, signature)."""
    hashed = Words()
    for batch in batches:
        for _, part in chunks(batch, 0):
            words, sizes = hashed(part)
            found = signatures(registers(*shingles(words, sizes), len(part), BITS))
            yield pa.RecordBatch.from_arrays([pa.array([word_key(t) for t in part], pa.binary()), pa.array(part, pa.binary()), *(pa.array(found[:, k]) for k in range(len(WORDS)))], names=["key", "folded", *WORDS])


def alike(a: str, b: str, threshold: float) -> Column:
    """Whether the signatures of two sides differ in no more bits than a verified pair may: half of the registers that
    disagree, and three standard deviations."""
    p = (1 - threshold) / 2
    most = int(BITS * p + 3 * (BITS * p * (1 - p)) ** 0.5)
    return reduce(add, (F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in WORDS)) <= most


def probability_jaccard(ha: np.ndarray, a: np.ndarray, hb: np.ndarray, b: np.ndarray) -> float:
    """Exact, of two bags given by sorted shingles and their counts."""
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = a / a.sum(), b / b.sum()
    a_only, b_only, a, b = 1 - a[i].sum(), 1 - b[j].sum(), a[i], b[j]
    order = np.argsort(b / a, kind="stable")  # largest a/b first
    a, b = a[order], b[order]
    lead = np.searchsorted(b / a, b / a, "right") - 1  # those with a ratio at least as large
    a_mass, b_mass = np.cumsum(a)[lead] + a_only, b.sum() - np.cumsum(b)[lead] + b_only
    return float((1 / (a_mass / a + b_mass / b)).sum())


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows of bounded text size; column 2 holds the texts and 3 those of their pivots."""
    first, size = 0, 0
    for row in range(batch.num_rows):
        size += batch.column(2)[row].as_buffer().size + batch.column(3)[row].as_buffer().size
        if size >= CHUNK:
            yield first, row + 1
            first, size = row + 1, 0
    if first < batch.num_rows:
        yield first, batch.num_rows


def verify(threshold: float):
    """Keeps the pairs (key, pivot, text, pivot_text) that are as similar as ``threshold``. The bags of a run of pairs are
    made at once, each text's only once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Words()
        for batch in batches:
            keys, pivots = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep, scores = [], []
            for first, end in runs(batch):
                place: dict[bytes, int] = {}
                bodies = []
                for names, column in ((keys, 2), (pivots, 3)):
                    for row in range(first, end):
                        if names[row] not in place:
                            place[names[row]] = len(bodies)
                            bodies.append(batch.column(column)[row].as_buffer().to_pybytes())
                owner, element, count = shingles(*hashed(bodies))
                edge = np.searchsorted(owner, np.arange(len(bodies) + 1))
                for row in range(first, end):
                    x, y = (slice(edge[i], edge[i + 1]) for i in (place[keys[row]], place[pivots[row]]))
                    score = probability_jaccard(element[x], count[x], element[y], count[y])
                    if score >= threshold - 1e-9:
                        keep.append(row)
                        scores.append(score)
            picked = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), pa.array(scores, pa.float64())], names=["key", "pivot", "similarity"])

    return run


def components(links: DataFrame, n: int) -> DataFrame:
    """A staged table with (key, label): the least key of the component of each linked key. Every key is its own neighbour
    too, so that one aggregation takes the least of its own and its neighbours' labels. The tables of a round are written in
    as many files as ``n`` links need."""
    files = 4 * n // EDGES + 1
    both = links.select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    edges = staged(both.withColumn("e", F.explode(F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x in "ab" for y in "ab")))).select("e.*").distinct().coalesce(files), "edges")
    labels = staged(edges.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("label")).coalesce(files), "labels")
    while True:
        now = labels.select("key", "label")
        near = edges.join(shuffled(now), edges["b"] == now["key"]).groupBy("a").agg(F.min("label").alias("least"), F.min(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("old"))
        up = now.select(F.col("key").alias("least"), F.col("label").alias("above"))
        better = staged(near.join(shuffled(up), "least").select(F.col("a").alias("key"), F.least("least", "above").alias("label"), "old").coalesce(files), "labels")
        discard(labels)
        labels = better
        if labels.where(F.col("label") != F.col("old")).isEmpty():
            discard(edges)
            return labels


def united(labels: DataFrame, links: DataFrame, own: bool) -> DataFrame:
    """The labels after new links, which are followed between classes, not between their members. ``own`` says that every
    key is still its own label."""
    ends = links.select("key", "pivot")
    if not own:
        at_key, at_pivot = labels.select("key", F.col("label").alias("a")), labels.select(F.col("key").alias("pivot"), F.col("label").alias("b"))
        ends = ends.join(shuffled(at_key), "key").join(shuffled(at_pivot), "pivot").select(F.col("a").alias("key"), F.col("b").alias("pivot"))
    roots = components(ends, links.count())
    new = staged(labels.join(shuffled(roots.select(F.col("key").alias("label"), F.col("label").alias("root"))), "label", "left").select("key", F.coalesce("root", "label").alias("label")), "labels")
    discard(labels), discard(roots)
    return new


def meeting(rows: DataFrame) -> DataFrame:
    """(bucket, uid) of the buckets with rows of several uids. A bucket is folded to two numbers before it is shuffled."""
    buckets = rows.where("bands is not null").select(F.explode("bands").alias("bucket"), "uid")
    several = buckets.groupBy("bucket").agg(F.min("uid").alias("low"), F.max("uid").alias("high")).where("low <> high").select("bucket")
    return buckets.join(shuffled(several), "bucket")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, folded, signature) of the texts whose doc_id is wanted; the ids are broadcast if they are few."""
    ids = wanted.select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.limit(FETCHED + 1).count() <= FETCHED else shuffled(ids)
    asked = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    fetched = asked.select("text").mapInArrow(signed, "key binary, folded binary, " + ", ".join(f"{w} long" for w in WORDS))
    return fetched.groupBy("key").agg(F.first(F.struct("folded", *WORDS)).alias("x")).select("key", "x.*")


def with_pivots(member: DataFrame, step: int, threshold: float) -> DataFrame:
    """Pairs of each member of a bucket with a few drawn members that are of other classes, drawn anew in each step."""
    drawn = [F.min(F.struct(F.xxhash64("key", F.lit(step), F.lit(k)).alias("draw"), "key", "label", *WORDS)) for k in range(DRAWN[step])]
    pivots = member.groupBy("bucket").agg(F.array(*drawn).alias("p"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    pivots = pivots.select("bucket", F.explode("p").alias("p")).select("bucket", "p.*")
    x, y = member.alias("x"), shuffled(pivots).alias("y")
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") != F.col("y.label")) & alike("x", "y", threshold))
    return pairs.select(F.greatest("x.key", "y.key").alias("key"), F.least("x.key", "y.key").alias("pivot")).distinct()


def with_others(member: DataFrame, threshold: float) -> DataFrame:
    """Pairs of each member outside a bucket's largest class with members of other classes, in the first bucket that both
    are in and nowhere else."""
    sizes = member.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("classes")).where("classes > 1").select("bucket", "main")
    member = staged(member.join(shuffled(largest), "bucket"), "mixed")
    all_of = member.groupBy("key").agg(F.collect_set("bucket").alias("buckets"))  # a key is in as many buckets as there are bands
    member = member.join(shuffled(all_of), "key")
    x, y = member.where("label <> main").alias("x"), shuffled(member).alias("y")
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.key") < F.col("y.key"))
    first = F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket")
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") != F.col("y.label")) & once & alike("x", "y", threshold) & first)
    return pairs.select(F.greatest("x.key", "y.key").alias("key"), F.least("x.key", "y.key").alias("pivot"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, n_links (verified links of its text), kept and
    text_sha256 (of the text as it is)."""
    small_batches(docs.sparkSession)
    plain = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = staged(plain.mapInArrow(sketch, "uid long, doc_id long, sha binary, key binary, bands array<long>"), "sketches")
    met = staged(meeting(rows), "met")
    who = staged(rows.select("uid", "doc_id", "key").join(shuffled(met.select("uid").distinct()), "uid", "left_semi"), "met")
    held = staged(texts_of(plain, who), "candidate-texts")
    member = met.join(shuffled(who.select("uid", "key")), "uid").select("bucket", "key").distinct()
    member = staged(member.join(shuffled(held.drop("folded")), "key"), "members")
    discard(met), discard(who)

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(shuffled(held.select("key", "folded")), "key").join(shuffled(held.select(F.col("key").alias("pivot"), F.col("folded").alias("pivot_text"))), "pivot")
        return both.select("key", "pivot", "folded", "pivot_text").mapInArrow(verify(threshold), "key binary, pivot binary, similarity double")

    labels, own, links, tried = held.select("key", F.col("key").alias("label")), True, [], []
    for step in range(len(DRAWN) + 1):
        placed = member.withColumn("label", F.col("key")) if own else member.join(shuffled(labels), "key")
        pairs = with_pivots(placed, step, threshold) if step < len(DRAWN) else with_others(placed, threshold)
        for before in tried:
            pairs = pairs.join(shuffled(before), ["key", "pivot"], "left_anti")
        tried.append(staged(pairs, "candidates"))
        links.append(staged(verified(tried[-1]), "links"))
        if not links[-1].isEmpty():
            labels, own = united(labels, links[-1], own), False
    degree = reduce(DataFrame.union, (found.select(end) for found in links for end in ("key", "pivot"))).groupBy("key").agg(F.count("*").alias("n_links"))
    named = staged(labels.join(shuffled(degree), "key"), "classes")  # keys with links
    for done in (held, member, labels, *tried, *links):
        discard(done)
    placed = rows.select("uid", "doc_id", "sha", "key").join(shuffled(named), "key", "left")
    placed = placed.select("uid", "doc_id", "sha", F.coalesce("label", "key").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    classes = placed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sha", "uid")).alias("head"), F.count("*").alias("class_size"))
    return placed.join(shuffled(classes), "label").select("doc_id", F.col("head.doc_id").alias("class_id"), "class_size", "n_links", (F.col("uid") == F.col("head.uid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of one document of each class; of rows of the same id and text the least by the other columns."""
    return kept_rows(docs, near_duplicates(docs, id_col, text_col), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256), id_col, text_col)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
