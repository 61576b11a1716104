"""Alignment of two tokenizations of the same texts by galloping intersection of their token ends.

Tokenizer A is byte-level (read as ranks, so that strings of special tokens are plain text), B a model of pieces with a
marker for space. The byte offsets where tokens of both end cut them into groups: each end of the shorter list is looked
for in the longer one with doubling steps and then by binary search, from where the last one was found. Within groups the
ranks of a token's start and end among the other's ends are the range of tokens that it overlaps.

Neither tokenizer joins characters over a single space between two others that aren't white space, so texts are cut into
chunks there; each different chunk of a task is tokenized and aligned once, many together in numpy. What a group of
documents holds, its results but for corpus-wide counts and the links as codes of its own list of pairs, is written as one row
of a table. The counts of pairs, in how many documents each is linked, are summed from those lists alone. The most
frequent pairs, at most ``PAIRS`` of them, and the highest count of each A id (no more than its vocabulary) are broadcast;
groups with other pairs get those by a join. Then the table is read once more for the columns that need counts.

Defined results: null or empty texts, and those whose tokens don't join to the text again (U+2581 in it, for one), have no
tokens, zeros and ''; each row is a document, also where ids or texts repeat; an empty table gives an empty table; a text is
taken whole whatever its length. Of equal counts all are the highest.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import small_batches, staged, table, texts
from pressmill.llm.packing import ChunkCache

#: Pairs whose counts are broadcast (16 bytes each); characters of a group of documents; chunks, and their characters, that a
#: task knows before it begins anew; characters that are tokenized in one go.
PAIRS, UNIT, CHUNKS, KNOWN, GO = 1 << 20, 1 << 21, 400_000, 1 << 25, 1 << 16
#: Cells of a table of documents and pairs that marks which document holds which pair.
CELLS = 1 << 25
MARK = "▁"
BITS = 32


def gallop(values: np.ndarray, long: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each value its place in an ascending list, at or after ``low``, or -1 where it isn't there. Steps from ``low`` double
    until they reach the value or go over it; then the last step is halved."""
    n = len(long)
    low, high, step = low.copy(), low.copy(), 1
    active = np.flatnonzero(high < n)
    while len(active := active[long[high[active]] < values[active]]):
        low[active] = high[active] + 1
        high[active] += step
        active, step = active[high[active] < n], 2 * step
    high = np.minimum(high, n)
    while len(active := np.flatnonzero(low < high)):
        middle = (low[active] + high[active]) // 2
        less = long[middle] < values[active]
        low[active] = np.where(less, middle + 1, low[active])
        high[active] = np.where(less, high[active], middle)
    at = np.minimum(low, n - 1)
    return np.where(long[at] == values, at, -1) if n else np.full(len(values), -1)


def chunks_of(text: str) -> list[str]:
    """The text with a space in front, cut before each single space between characters that aren't white space."""
    parts = text.split(" ")
    if not any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
        return [" " + p for p in parts]
    out, held = [], ""
    for k, p in enumerate(parts):
        if k and p and not p[0].isspace() and parts[k - 1] and not parts[k - 1][-1].isspace():
            out.append(held)
            held = ""
        held += " " + p
    return [*out, held]


class Aligner:
    """Two tokenizers, and the entries of each as bytes and in writing."""

    def __init__(self, byte_model: str, piece_model: str):
        from sentencepiece import SentencePieceProcessor

        self.whole = ChunkCache(byte_model)
        self.a = byte_entries(self.whole.whole.get_vocab())
        self.sp = SentencePieceProcessor(model_file=piece_model)
        self.b = [bytes([int(self.sp.id_to_piece(i)[3:5], 16)]) if self.sp.is_byte(i) else self.sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(self.sp.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in entries]) for entries in (self.a, self.b))
        # what is written for a token of A, and for one of B, within its side of a group and at its end
        numbers_a, numbers_b = (list(map(str, range(len(x)))) for x in (self.a, self.b))
        self.writing = [x + end for numbers, ends in ((numbers_a, ",|"), (numbers_b, ",;")) for end in ends for x in numbers]
        self.first = np.cumsum([0, len(self.a), len(self.a), len(self.b)])

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B of a text with a space in front; None where they don't join to it again."""
        a, b = self.whole.fast.encode_ordinary(text), self.sp.encode(text[1:])
        data = text.encode()
        if b"".join(map(self.a.__getitem__, a)) != data or b"".join(map(self.b.__getitem__, b)) != data:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def aligned(self, chunks: list[str]) -> tuple[np.ndarray, ...]:
        """(n_a, n_b, n_groups, n_links of each chunk, -1 where bytes differ; all links; the groups of each in writing)"""
        ids_a, ids_b, sizes, good = [], [], [], np.ones(len(chunks), bool)
        plain = [len(c) > 1 and not c[1].isspace() and not c[-1].isspace() for c in chunks]
        k = 0
        while k < len(chunks):
            upto, length = k + 1, len(chunks[k])
            while upto < len(chunks) and plain[k] and plain[upto] and length < GO:  # cut again where they are joined
                length += len(chunks[upto])
                upto += 1
            found = self.tokens("".join(chunks[k:upto]))
            if found is None and upto > k + 1:
                singly = [self.tokens(c) for c in chunks[k:upto]]
                good[k:upto] = [x is not None for x in singly]
                found = tuple(np.concatenate([x[side] for x in singly if x is not None] or [np.zeros(0, np.int64)]) for side in (0, 1))
            elif found is None:
                good[k] = False
                found = (np.zeros(0, np.int64),) * 2
            ids_a.append(found[0])
            ids_b.append(found[1])
            k = upto
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        sizes = np.array([len(c.encode()) for c in chunks]) * good
        return self.grouped(a, b, sizes, good)

    def grouped(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, ...]:
        ends_a, ends_b, bounds = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.cumsum(sizes)
        begin = bounds - sizes
        none = np.zeros(len(sizes), np.int64)
        if not len(a):
            return none - ~good, none, none, none, np.zeros(0, np.int64), [""] * len(sizes)
        # where each chunk's tokens begin in either list; each chunk ends where a token of both does
        upto_a, upto_b = (gallop(bounds[good], ends, np.zeros(good.sum(), np.int64)) + 1 for ends in (ends_a, ends_b))
        n_a, n_b = none.copy(), none.copy()
        n_a[good], n_b[good] = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        chunk_a, chunk_b = np.repeat(np.arange(len(sizes)), n_a), np.repeat(np.arange(len(sizes)), n_b)
        from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # the shorter list of ends is looked up in the longer, from where its chunk begins there
        if len(a) <= len(b):
            place = gallop(ends_a, ends_b, from_b[chunk_a])
            cut_a, cut_b = np.flatnonzero(place >= 0), place[place >= 0]
        else:
            place = gallop(ends_b, ends_a, from_a[chunk_b])
            cut_a, cut_b = place[place >= 0], np.flatnonzero(place >= 0)
        n_groups = np.bincount(chunk_a[cut_a], minlength=len(sizes))
        # overlaps by ranks: B's first token that ends after a token of A begins, to its first that ends where that ends or later
        low, high = np.searchsorted(ends_b, ends_a - self.size_a[a], "right"), np.searchsorted(ends_b, ends_a, "left")
        times = high - low + 1
        of_b = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        links = (np.repeat(a, times) << BITS) | b[of_b]
        n_links = np.bincount(chunk_a, times, len(sizes)).astype(np.int64)
        # in writing: group after group, the tokens of A and then those of B
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a] = last_b[cut_b] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        sides = np.concatenate([self.first[last_a] + a, self.first[2 + last_b] + b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        written = list(map(self.writing.__getitem__, sides[order].tolist()))
        to = np.cumsum(n_a + n_b).tolist()
        return n_a - ~good, n_b, n_groups, n_links, links, ["".join(written[x:y])[:-1] for x, y in zip([0, *to], to)]


class Known:
    """What a task knows of chunks, by their numbers: counts, the places of their links as codes of pairs, writing."""

    def __init__(self, own: Aligner):
        self.own, self.number, self.size = own, {}, 0
        self.pairs: dict[int, int] = {}
        self.counts, self.links, self.written = np.zeros((4, 0), np.int64), np.zeros(0, np.int32), []

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the chunks of each text; those that are new are aligned together."""
        before, number = len(self.number), self.number
        found = [np.array([number.setdefault(c, len(number)) for c in chunks_of(t)], np.int64) if t else np.zeros(0, np.int64) for t in texts]
        if len(number) > before:
            new = list(number)[before:]
            self.size += sum(map(len, new))
            *counts, links, written = self.own.aligned(new)
            pairs, codes = np.unique(links, return_inverse=True)
            code = np.array([self.pairs.setdefault(p, len(self.pairs)) for p in pairs.tolist()], np.int32)
            self.counts = np.concatenate([self.counts, counts], 1)
            self.links = np.concatenate([self.links, code[codes] if len(pairs) else np.zeros(0, np.int32)])
            self.written += written
        return found

    def full(self) -> bool:
        return len(self.number) > CHUNKS or self.size > KNOWN


def laid_out(start: np.ndarray, times: np.ndarray) -> np.ndarray:
    """start, start + 1 and so on, so many times each."""
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start, times)


def byte_entries(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of each entry: printable characters of Latin-1 stand for themselves, other bytes for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return out


def aligner(models: tuple[str, str]) -> Aligner:
    kept = sys.modules.setdefault("_aligners", type(sys)("_aligners")).__dict__  # lives as long as the worker
    return kept.get(models) or kept.setdefault(models, Aligner(*models))


LONGS, INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
UNIT_FIELDS = [("unit", pa.int64()), ("ids", LONGS), *((c, LONGS) for c in COLUMNS), ("shas", pa.list_(pa.string())), ("pairs", LONGS), ("df", INTS), ("codes", pa.binary())]
UNITS = "unit long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, shas array<string>, pairs array<long>, df array<int>, codes binary"


def units(docs: DataFrame, models: tuple[str, str], with_groups: bool) -> DataFrame:
    """A row for each group of documents: their results but for counts, the pairs of ids linked in them, in how many of them
    each is, and all links, document after document, as places in the list of pairs, low bytes first and then higher ones."""
    schema = pa.schema(UNIT_FIELDS + [("groups", pa.list_(pa.string()))] * with_groups)

    def unit_of(number: int, known: Known, ids: list, values: list[str]) -> pa.RecordBatch:
        chunks = known.numbers(values)
        length = np.array([len(c) for c in chunks])
        chunk, doc = np.concatenate(chunks), np.repeat(np.arange(len(ids)), length)
        counts = known.counts[:, chunk]
        good = length > 0
        good[doc[counts[0] < 0]] = False
        totals = [np.bincount(doc, row, len(ids)).astype(np.int64) * good for row in counts]
        per_chunk = known.counts[3]
        begin = np.cumsum(per_chunk) - per_chunk
        kept = good[doc]
        links = known.links[laid_out(begin[chunk[kept]], per_chunk[chunk[kept]])]
        used = np.bincount(links, minlength=len(known.pairs))
        codes = np.argsort(-used, kind="stable")[: (used > 0).sum()]  # the most frequent first
        place = np.zeros(len(known.pairs), np.int64)
        place[codes] = np.arange(len(codes))
        links, owner = place[links], np.repeat(doc[kept], per_chunk[chunk[kept]])
        if len(ids) * len(codes) <= CELLS:
            holds = np.zeros((len(ids), len(codes)), bool)
            holds[owner, links] = True
            df = holds.sum(0)
        else:
            df = np.bincount(np.unique(owner * len(codes) + links) % len(codes), minlength=len(codes))
        pairs = np.fromiter(known.pairs, np.int64, len(known.pairs))[codes]
        planes = b"".join(((links >> shift) & 255).astype(np.uint8).tobytes() for shift in (range(0, 32, 8) if len(codes) > 1 << 16 else (0, 8)))
        groups = [";".join(map(known.written.__getitem__, c.tolist())) if ok else "" for c, ok in zip(chunks, good.tolist())]
        shas = [hashlib.sha256(g.encode()).hexdigest() if ok else "" for g, ok in zip(groups, good.tolist())]
        row = [number, ids, *totals, shas, pairs, df.astype(np.int32), planes, *[groups] * with_groups]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known = TaskContext.get().partitionId() << 32, Known(aligner(models))
        ids, values, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                values.append(text)
                size += len(text)
                if size >= UNIT:
                    yield unit_of(number, known, ids, values)
                    number, ids, values, size = number + 1, [], [], 0
                    if known.full():
                        known = Known(known.own)
        if ids:
            yield unit_of(number, known, ids, values)

    return texts(docs).mapInArrow(run, UNITS + ", groups array<string>" * with_groups)


def pair_counts(held: DataFrame) -> DataFrame:
    """(pair, n): in how many documents of all a pair of ids is linked; the A id is in the high bits."""
    rows = held.select(F.explode(F.arrays_zip("pairs", "df")).alias("x"))
    return rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.df").alias("n"))


def frequent(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The pairs of greatest count, ``most`` at the most, and the others (None if there are none). All pairs of one step of
    count, steps being an eighth of a doubling, are on the same side."""
    step = F.floor(F.log2("n") * 8)
    steps = sorted(((r["step"], r["pairs"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs")).collect()), reverse=True)  # 512 at most
    reach = list(accumulate(n for _, n in steps))
    fits = sum(r <= most for r in reach)
    if fits == len(steps):
        return counts, None
    least = steps[fits - 1][0] if fits else float("inf")
    return counts.where(step >= least), counts.where(step < least)


def alignments(docs: DataFrame, byte_model: str | None = None, piece_model: str | None = None, pairs: int = PAIRS, with_groups: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups, written out)."""
    spark = docs.sparkSession
    small_batches(spark)
    models = (byte_model or public_tokenizers.path("byte_bpe_50k.json"), piece_model or public_tokenizers.path("piece_bpe_32k.model"))
    held = staged(units(docs, models, with_groups), "units")
    counts = staged(pair_counts(held), "pairs")
    often, seldom = frequent(counts, pairs)
    best = counts.groupBy(F.shiftright("pair", BITS).alias("a")).agg(F.max("n").alias("most"))
    shared = spark.sparkContext.broadcast((*arrays(often, "pair", "n"), *arrays(best, "a", "most")))
    if seldom is not None:
        asked = held.select("unit", F.explode("pairs").alias("pair")).join(seldom, "pair")
        held = held.join(asked.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("pair", "n"))).alias("rare")), "unit", "left")
        held = held.withColumns({"rare_pairs": F.col("rare.pair"), "rare_n": F.col("rare.n")}).drop("rare")
    names = ("doc_id", *COLUMNS, "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups)
    kinds = (*[pa.int64()] * 7, *[pa.string()] * (1 + with_groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times, ids, most = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                pair, planes = np.array(row["pairs"], np.int64), np.frombuffer(row["codes"], np.uint8)
                known, n = often, times
                if row.get("rare_pairs"):
                    known, n = np.r_[often, row["rare_pairs"]], np.r_[times, row["rare_n"]]
                    order = np.argsort(known, kind="stable")
                    known, n = known[order], n[order]
                count = n[np.searchsorted(known, pair)]
                is_best = count == most[np.searchsorted(ids, pair >> BITS)]
                links = np.zeros(sum(row["n_links"]), np.int64)
                for k, plane in enumerate(planes.reshape(-1, len(links)) if len(links) else ()):
                    links |= plane.astype(np.int64) << 8 * k
                owner = np.repeat(np.arange(len(row["ids"])), row["n_links"])
                count_sum = np.zeros(len(row["ids"]), np.int64)
                np.add.at(count_sum, owner, count[links])
                n_best = np.bincount(owner, is_best[links], len(row["ids"])).astype(np.int64)
                columns = [row["ids"], *(row[c] for c in COLUMNS), n_best, count_sum, row["shas"], *[row.get("groups")] * with_groups]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=list(names))

    return held.mapInArrow(run, ", ".join(f"{n} {'string' if 'groups' in n and n != 'n_groups' else 'long'}" for n in names))


def arrays(rows: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Two columns as arrays, by the first."""
    got = rows.select(F.col(key).cast("long"), F.col(value).cast("long")).toArrow()
    keys, values = (got.column(c).to_numpy() for c in (0, 1))
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(table(spark, sf_dir, "documents"))
