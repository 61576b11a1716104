"""Removal of long repeated passages with suffix arrays.

Each byte covered by a string of ``length`` bytes that also starts anywhere else in the corpus is removed. Sorting all
suffixes of a large corpus in one place can't be done, so the strings are sharded by content: in every window of
``length`` bytes the 32-byte gram with the least hash, the first of them, is the window's anchor, and equal windows have equal
anchors. Runs of windows with one anchor are the unit of work; their bytes are its context. Equal contexts of an anchor
are counted before they are shuffled, anchors that occur once are dropped, and contexts of the rest are put together in
shards of about ``SHARD`` bytes. Equal windows lie alike around their anchor, so windows whose anchor is equally deep have
a piece of nearly ``length`` bytes in common: contexts that share no such piece with another hold no repeat and are left
out, and the contexts of an anchor with many of them are dealt out by their pieces. A shard gets a suffix array by Larsson-Sadakane refinement (sort by eight bytes, then
double the depth within groups that are still equal) and common prefixes by Kasai's inequality, both in numpy. Where even
a piece has many contexts, they are split over sub-shards, and each pair of these is merged by binary search of the one's
windows in the other's suffix array. What was found for a context is joined back to all its places.

Defined results: null counts as empty; matches are of UTF-8 bytes and never cross documents; a text shorter than
``length`` loses nothing; rows of equal text remove each other; ids may be null or repeat; an empty table gives an empty
table. The kept bytes may break a character apart, as the rule says.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import small_batches, staged, table, texts

LENGTH = 400
GRAM = 32
SHARD = 1 << 20
#: Contexts of an anchor, or of a piece, in one sub-shard.
SUB = 512
#: Classes of windows by the depth of their anchor, when a shard is thinned and when an anchor is split.
THIN, SPLIT = 4, 8
CHUNK = 1 << 20
POSITION_BITS = 25
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Sums:
    """Hashes of any stretches of a byte string, from prefix sums of a polynomial."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray):
        n = len(data)
        if len(self.powers) < n + 1:
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n, ODD[0], np.uint64)])
            self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(ODD[0], -1, 1 << 64), np.uint64)])
        total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n])]
        return lambda start, end: (total[end] - total[start]) * self.inverses[start]


def depths(length: int, classes: int) -> list[tuple[int, int]]:
    """The least and the greatest depth of the anchor in a window, of each class of windows."""
    cuts = [(length - GRAM + 1) * k // classes for k in range(classes + 1)]
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:]) if a < b]


class Anchors:
    """Anchored runs of windows of many texts at once."""

    def __init__(self, length: int):
        self.length, self.sums = length, Sums()

    def __call__(self, parts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, anchor hash, context digest, first start, last start - first start, anchor's place after the first start)
        of each run, starts within the text."""
        length, sizes = self.length, np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        n, none = len(data), tuple(np.zeros(0, np.int64) for _ in range(6))
        if n < length or (sizes < length).all():
            return none
        x = data.astype(np.uint64) + np.uint64(1)
        stretch = self.sums(data)
        gram, step = x, 1
        while step < GRAM:
            gram = scramble(gram[:-step] * np.uint64(ODD[1]) + gram[step:] * np.uint64(ODD[2]))
            step *= 2
        # the least hash of each window and, with the position in the low bits, the first place that has it
        keyed = (gram >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | np.arange(len(gram), dtype=np.uint64)
        width = length - GRAM + 1
        rows = -(-len(keyed) // width)
        padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(keyed)] = keyed
        padded = padded.reshape(rows, width)
        ahead = np.minimum.accumulate(padded, 1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
        windows = n - length + 1
        least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
        at = (least & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        own = np.maximum(sizes - length + 1, 0)
        text = np.repeat(np.arange(len(parts)), own)
        start = np.arange(len(text)) - np.repeat(np.cumsum(own) - own, own) + begin[text]
        anchor = at[start]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        first, last = start[new], start[np.r_[new[1:], len(start)] - 1]
        digest = scramble(stretch(first, last + length) + (last - first).astype(np.uint64) * np.uint64(ODD[1]))
        return text[new], gram[anchor[new]].astype(np.int64), digest.astype(np.int64), first - begin[text[new]], last - first, anchor[new] - first


def text_key(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def runs_of(length: int):
    """(doc_id, text) to (doc_id, key, n_bytes, and by anchor and digest: spans, places of the anchor and lists of first starts). The lists are
    null for a text seen twice before in the partition: two rows already say that it repeats."""
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n_bytes", pa.int64()), ("anchors", longs), ("digests", longs), ("spans", ints), ("offsets", ints), ("starts", pa.list_(ints))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, once, twice = Anchors(length), set(), set()
        for batch in batches:
            values = [v.as_buffer().to_pybytes() for v in batch.column(1)]
            keys = [text_key(v) for v in values]
            new = []
            for i, k in enumerate(keys):
                if k not in twice:
                    (twice if k in once else once).add(k)
                    new.append(i)
            if len(once) > 1 << 18:
                once.clear(), twice.clear()
            lists: list = [None] * len(values)
            k = 0
            while k < len(new):
                size, upto = 0, k
                while upto < len(new) and size < CHUNK:
                    size += len(values[new[upto]])
                    upto += 1
                part = new[k:upto]
                for i, found in zip(part, grouped(find, [values[i] for i in part], length)):
                    lists[i] = found
                k = upto
            columns = [[row[c] if row is not None else None for row in lists] for c in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array([len(v) for v in values], pa.int64()), *(pa.array(c, schema.field(3 + j).type) for j, c in enumerate(columns))], schema=schema)

    return run


def segments(value: bytes, length: int) -> list[tuple[int, bytes]]:
    """A very long text in overlapping parts, so that each window lies in exactly one of them."""
    step = (1 << POSITION_BITS) - length
    return [(a, value[a : a + step + length - 1]) for a in range(0, max(1, len(value) - length + 1), step)]


def grouped(find: Anchors, values: list[bytes], length: int) -> list[tuple[list, list, list, list, list]]:
    """For each text the lists (anchors, digests, spans, places of the anchor, first starts of each)."""
    parts, owner, shift = [], [], []
    out: list[tuple[list, list, list, list, list]] = [([], [], [], [], []) for _ in values]

    def take() -> None:
        text, anchor, digest, first, span, offset = find(parts)
        order = np.lexsort((first, digest, anchor, text))
        text, anchor, digest, first, span, offset = (x[order] for x in (text, anchor, digest, first, span, offset))
        if not len(text):
            return
        new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])])
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(text)]):
            t = int(text[a])
            row = out[owner[t]]
            row[0].append(int(anchor[a]))
            row[1].append(int(digest[a]))
            row[2].append(int(span[a]))
            row[3].append(int(offset[a]))
            row[4].append((first[a:b] + shift[t]).tolist())

    size = 0
    for i, value in enumerate(values):
        for at, part in segments(value, length):
            if parts and size + len(part) >= 1 << POSITION_BITS:
                take()
                parts.clear(), owner.clear(), shift.clear()
                size = 0
            parts.append(part)
            owner.append(i)
            shift.append(at)
            size += len(part)
    if parts:
        take()
    return out


# --- suffix arrays ---


def packed(data: bytes, length: int) -> np.ndarray:
    """The eight bytes from each position on, big endian; zeros past the end."""
    b = np.frombuffer(data + b"\0" * (length + 16), np.uint8)
    n = len(data) + length + 8
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | b[k : k + n]
    return out


def suffix_array(data: bytes) -> np.ndarray:
    """Larsson-Sadakane: all positions in the order of their suffixes. The order has to be complete, also past the length
    that matters, for Kasai's inequality to hold."""
    n = len(data)
    key = packed(data, 0)[:n]
    sa = np.argsort(key, kind="stable")
    rank = np.zeros(n + 1, np.int64)  # past the end: below all
    head = np.r_[True, key[sa[1:]] != key[sa[:-1]]]
    depth = 8
    while True:
        start = np.flatnonzero(head)
        rank[sa] = 1 + np.repeat(start, np.diff(np.r_[start, n]))
        if len(start) == n:
            return sa
        tied = np.flatnonzero(~(head & np.r_[head[1:], True]))  # places in groups of two or more
        at = sa[tied]
        group = rank[at]
        second = rank[np.minimum(at + depth, n)]
        order = np.argsort(group * np.int64(n + 1) + second, kind="stable")
        sa[tied] = at[order]
        group, second = group[order], second[order]
        head[tied] = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        depth *= 2


def common_prefixes(data: bytes, sa: np.ndarray, length: int, block: int = 16) -> np.ndarray:
    """For each place of the suffix array the prefix shared with the place before, at most ``length``, in steps that make
    ``length`` itself exact. Kasai's inequality, a prefix is at most one shorter than that of the position before,
    carries each value on to the next position; the first position of each block of text starts at nothing."""
    n = len(sa)
    words = packed(data, length)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(n, np.int64)
    for offset in range(block):
        at = np.arange(offset, n, block)
        if offset:
            shared[at] = np.maximum(shared[at - 1] - 1, 0)
            shared[at] = np.where((before[at] >= 0) & (before[at - 1] >= 0), shared[at], 0)
        at = at[before[at] >= 0]
        while len(at):
            at = at[shared[at] < length]
            done = shared[at]
            more = np.minimum(8, length - done)
            same = (words[at + done] ^ words[before[at] + done]) >> (64 - 8 * more).astype(np.uint64) == 0
            at, more = at[same], more[same]
            shared[at] += more
    return shared[sa]


def repeated(data: bytes, starts: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Which of the window starts are of a string that occurs twice, counting each as often as its weight."""
    sa = suffix_array(data)
    group = np.cumsum(common_prefixes(data, sa, length) < length)
    of = np.zeros(len(data), np.int64)
    of[sa] = group
    mine = of[starts]
    return np.bincount(mine, weight)[mine] >= 2


def merged(data: bytes, starts: np.ndarray, other: bytes, other_starts: np.ndarray, length: int) -> np.ndarray:
    """Which windows of one shard occur among the other's: binary search in the other's suffix array."""
    sa = suffix_array(other)
    valid = np.zeros(len(other), bool)
    valid[other_starts] = True
    sa = sa[valid[sa]]
    a, b = packed(data, length), packed(other, length)

    def compare(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the window at x in data is less than, equal to or greater than that at y in other."""
        out, live = np.zeros(len(x), np.int8), np.arange(len(x))
        for done in range(0, length, 8):
            cut = np.uint64(64 - 8 * min(8, length - done))
            p, q = a[x[live] + done] >> cut, b[y[live] + done] >> cut
            out[live[p < q]], out[live[p > q]] = -1, 1
            live = live[p == q]
            if not len(live):
                break
        return out

    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(sa))
    while (low < high).any():
        mid = (low + high) // 2
        go = low < high
        side = np.zeros(len(starts), np.int8)
        side[go] = compare(starts[go], sa[mid[go]])
        low = np.where(go & (side > 0), mid + 1, low)
        high = np.where(go & (side <= 0), mid, high)
    found = low < len(sa)
    found[found] = compare(starts[found], sa[low[found]]) == 0
    return found


def shared_pieces(stretch, begin: np.ndarray, spans: np.ndarray, offsets: np.ndarray, groups: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Which contexts have a piece that another of their group, or they themselves elsewhere, have as well. A context of
    windows with the anchor at depths from ``offset - span`` to ``offset`` holds the whole piece of each class that it
    has windows of."""
    out = weight >= 2
    for k, (low, high) in enumerate(depths(length, THIN)):
        has = np.flatnonzero((low <= offsets) & (high >= offsets - spans))
        at = begin[has] + offsets[has]
        h = scramble(scramble(stretch(at - low, at - high + length)) + groups[has].astype(np.uint64) * np.uint64(ODD[1]))
        _, which = np.unique(h, return_inverse=True)
        out[has] |= np.bincount(which, weight[has])[which] >= 2
    return out


def shard_search(length: int, shard: int):
    """(part, i, j, sub, digest, n, span, context, offset, anchor, shift), sorted by the first three, to (anchor, digest,
    runs) with the starts from a to b of the context repeated. Rows with i = j are searched together, many parts in a shard; of i < j the
    windows of each sub-shard are looked up in the other."""
    run_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("runs", run_type)])
    sums = Sums()

    def starts_of(rows: list[tuple]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        spans = np.array([r[6] + 1 for r in rows])
        begin = np.cumsum([0, *(len(r[7]) for r in rows[:-1])])
        owner = np.repeat(np.arange(len(rows)), spans)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans) + begin[owner]
        return b"".join(r[7] for r in rows), start, owner, begin

    def told(rows: list[tuple], start: np.ndarray, owner: np.ndarray, begin: np.ndarray, found: np.ndarray) -> Iterator[tuple]:
        start, owner = start[found], owner[found]
        if not len(start):
            return
        new = np.flatnonzero(np.r_[True, (np.diff(start) != 1) | (np.diff(owner) != 0)])
        ends = np.r_[new[1:], len(start)] - 1
        by: dict[int, list] = {}
        for o, a, b in zip(owner[new].tolist(), (start[new] - begin[owner[new]]).tolist(), (start[ends] - begin[owner[ends]]).tolist()):
            by.setdefault(o, []).append({"a": a + rows[o][10], "b": b + rows[o][10]})
        for o, found_runs in by.items():
            yield rows[o][9], rows[o][4], found_runs

    def one(rows: list[tuple]) -> Iterator[tuple]:
        spans, offsets, groups, weight = (np.array([r[c] for r in rows], t) for c, t in ((6, np.int64), (8, np.int64), (0, np.int64), (5, float)))
        begin = np.cumsum([0, *(len(r[7]) for r in rows[:-1])])
        stretch = sums(np.frombuffer(b"".join(r[7] for r in rows), np.uint8))
        rows = [rows[k] for k in np.flatnonzero(shared_pieces(stretch, begin, spans, offsets, groups, weight, length))]
        if not rows:
            return
        data, start, owner, begin = starts_of(rows)
        weight = np.array([r[5] for r in rows], float)[owner]
        yield from told(rows, start, owner, begin, repeated(data, start, weight, length))

    def two(rows: list[tuple]) -> Iterator[tuple]:
        halves = [[r for r in rows if r[3] == r[1]], [r for r in rows if r[3] == r[2]]]
        if all(halves):
            (da, sa, oa, ba), (db, sb, ob, bb) = (starts_of(h) for h in halves)
            yield from told(halves[0], sa, oa, ba, merged(da, sa, db, sb, length))
            yield from told(halves[1], sb, ob, bb, merged(db, sb, da, sa, length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            held, size, last = [], 0, None
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in range(11))):
                    if row[:3] != last:
                        if held and (last[1] != last[2] or row[1] != row[2] or size >= shard):
                            yield from (one if last[1] == last[2] else two)(held)
                            held, size = [], 0
                        last = row[:3]
                    held.append(row)
                    size += len(row[7])
            if held:
                yield from (one if last[1] == last[2] else two)(held)

        part: list[tuple] = []
        for row in found():
            part.append(row)
            if len(part) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    return run


def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([text_key(v.as_buffer().to_pybytes()) for v in batch.column(0)], pa.binary()), batch.column(0)], names=["key", "text"])


def contexts(length: int, sub: int):
    """(text, list of contexts) to a row of each with its bytes; of an anchor with more than ``sub`` contexts a row for each
    class of its windows, with the bytes of these alone and a part named after their common piece."""
    schema = pa.schema([("part", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("span", pa.int32()), ("context", pa.binary()), ("offset", pa.int32()), ("anchor", pa.int64()), ("shift", pa.int32())])
    classes = depths(length, SPLIT)

    def rows_of(text: bytes, w: dict) -> Iterator[tuple]:
        start, span, offset, anchor = w["start"], w["span"], w["offset"], w["anchor"]
        if w["m"] <= sub:
            yield anchor, w["digest"], w["n"], span, text[start : start + span + length], offset, anchor, 0
            return
        for k, (low, high) in enumerate(classes):
            deep, flat = min(high, offset), max(low, offset - span)
            if deep >= flat:
                at, shift = start + offset, offset - deep
                piece = hashlib.blake2b(text[at - low : at - high + length], digest_size=8, key=struct.pack("<qq", anchor, k)).digest()
                yield int.from_bytes(piece, "little", signed=True), w["digest"], w["n"], deep - flat, text[at - deep : at - flat + length], deep, anchor, shift

    def run(batches):
        for batch in batches:
            rows = [row for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in wanted for row in rows_of(text, w)]
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 4096]), schema)], schema=schema)

    return run


def cut_out(length: int):
    """(key, text, places of (start, runs)) to (key, n_removed, n_spans, kept_sha256, kept)."""
    schema = pa.schema([("key", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            rows = []
            for key, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans: list[list[int]] = []
                for a, b in sorted((p["a"], p["b"]) for p in places):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                at, kept = 0, []
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                left = b"".join([*kept, text[at:]])
                rows.append((key, len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD, sub: int = SUB, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes, on request)."""
    small_batches(docs.sparkSession)
    plain = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    lists = "anchors array<long>, digests array<long>, spans array<int>, offsets array<int>, starts array<array<int>>"
    rows = staged(plain.mapInArrow(runs_of(length), f"doc_id long, key binary, n_bytes long, {lists}"), "runs")
    places = rows.where(F.size("anchors") > 0).select("key", F.explode(F.arrays_zip("anchors", "digests", "spans", "offsets", "starts")).alias("r"))
    places = places.select("key", F.col("r.anchors").alias("anchor"), F.col("r.digests").alias("digest"), F.col("r.spans").alias("span"), F.col("r.offsets").alias("offset"), F.col("r.starts").alias("starts"))
    often = places.groupBy("anchor").agg(F.sum(F.size("starts")).alias("times")).where("times > 1").select("anchor")
    places = staged(places.join(often, "anchor"), "places")
    distinct = places.groupBy("anchor", "digest").agg(F.sum(F.size("starts")).alias("n"), F.min(F.struct("key", F.col("starts")[0].alias("start"), "span", "offset")).alias("one"))
    many = distinct.groupBy("anchor").agg(F.count("*").alias("m"))
    wanted = distinct.join(many, "anchor").select(F.col("one.key").alias("key"), F.struct("anchor", "digest", "n", "m", F.col("one.span").alias("span"), F.col("one.offset").alias("offset"), F.col("one.start").alias("start")).alias("w"))
    touched = places.select("key").distinct()
    # the texts of all places, once each; what is cut out of them later is read from here as well
    held = staged(plain.select("text").mapInArrow(with_key, "key binary, text binary").join(touched, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "touched")
    asked = held.join(wanted.groupBy("key").agg(F.collect_list("w").alias("wanted")), "key")
    found = asked.select("text", "wanted").mapInArrow(contexts(length, sub), "part long, digest long, n long, span int, context binary, offset int, anchor long, shift int")
    # parts of split anchors: those of one context that occurs once go, those still large are split again
    found = staged(found, "contexts")
    split = found.where("part <> anchor").groupBy("part").agg(F.count("*").alias("rows"), F.sum("n").alias("times"))
    split = found.where("part <> anchor").join(split.where("times > 1"), "part").withColumn("parts", F.ceil(F.col("rows") / sub).cast("int")).drop("rows", "times")
    found = found.where("part = anchor").withColumn("parts", F.lit(1)).unionByName(split)
    found = found.withColumn("sub", F.pmod(F.col("digest"), F.col("parts")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = found.select("part", F.least("sub", "with").alias("i"), F.greatest("sub", "with").alias("j"), "sub", "digest", "n", "span", "context", "offset", "anchor", "shift")
    found = found.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")
    runs = found.mapInArrow(shard_search(length, shard), "anchor long, digest long, runs array<struct<a:int,b:int>>")
    runs = staged(runs.select("anchor", "digest", F.explode("runs").alias("run")).select("anchor", "digest", "run.a", "run.b"), "repeated")
    spans = places.join(runs, ["anchor", "digest"]).select("key", F.explode("starts").alias("start"), "a", "b")
    spans = spans.select("key", F.struct((F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b") + length).alias("b")).alias("p"))
    spans = spans.groupBy("key").agg(F.collect_list("p").alias("places"))
    cut = held.join(spans, "key").select("key", "text", "places").mapInArrow(cut_out(length), "key binary, n_removed long, n_spans long, kept_sha256 string, kept binary")
    if not with_text:
        cut = cut.drop("kept")
    result = rows.select("doc_id", "key", "n_bytes").join(cut, "key", "left")
    out = ["doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", F.lower(F.hex("key"))).alias("kept_sha256")]
    return result.select(*out, *["kept"] * with_text)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).withColumn("has_repeats", F.col("n_removed") > 0)
