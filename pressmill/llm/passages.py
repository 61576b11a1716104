"""Removal of repeated passages of words by fixed-block anchors.

A window is ``window`` consecutive words of one text. Every text's non-overlapping blocks of half a window are the
reference index; every rolling block of every text is a probe. A window that occurs twice holds a whole reference block of
its other occurrence, so only around probes that hit a block can a window repeat. A hit is extended to both sides into all
windows that hold it; windows are compared by the hashes of both their halves (128 bits), and of equal ones all but the
earliest are struck. Their union is what maximal exact repeats cover.

Texts are first written in chunks of some megabytes, bucketed by chunk. Probes go to buckets of their hash as arrays, 32
further bits of each in place order, and come back as one bit each; so do the extended windows. Both answers join the
chunks by their bucketing, so a text is never shuffled. Of windows repeated within a chunk only the first is sent. A phrase in
every text adds one probe a text to a bucket that holds millions of others.

Defined results: null counts as no words; texts shorter than a window lose nothing; rows are ordered by doc_id (null first),
rows of one doc_id by the digest of their text, and a row repeated whole loses all of its windows but in one copy; an empty
table gives an empty table. A text stays whole in its chunk, so memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import shared_dir, small_batches, staged, table, texts
from pressmill.llm.repeats import ODD, Sums, scramble

WINDOW = 20
#: Bytes of text in a chunk.
CHUNK = 4 << 20
#: Probes, or windows, that a bucket may hold, and the least number of buckets.
PROBES, WINDOWS, BUCKETS = 16 << 20, 4 << 20, 64
#: Bytes of text in a bucket of the chunk table.
SCAN = 16 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return scramble(a * np.uint64(ODD[1]) + b * np.uint64(ODD[2]))


def grams(code: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; there are n - 1 places less than words."""
    if n == 1:
        return code
    half = grams(code, n // 2)
    places = len(code) - n + 1
    out = mixed(half[:places], half[n // 2 : n // 2 + places])
    return mixed(out, code[n - 1 :]) if n % 2 else out


class Words:
    """The words of the texts of a chunk, each text followed by one space."""

    def __init__(self, data: bytes, sizes: np.ndarray, window: int, sums: Sums):
        self.data, self.sizes, self.window = np.frombuffer(data, np.uint8), sizes, window
        edge = np.flatnonzero(np.diff(np.r_[True, SPACE[self.data], True].view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        self.begin = np.cumsum(sizes + 1) - (sizes + 1)
        self.doc = np.searchsorted(self.begin, self.start, "right") - 1
        self.n = np.bincount(self.doc, minlength=len(sizes))
        first = np.cumsum(self.n) - self.n
        self.place = np.arange(len(self.doc)) - first[self.doc]
        self.left = self.n[self.doc] - self.place  # words from here to the end of the text
        self.block = (window + 1) // 2
        code = scramble(sums(self.data)(self.start, self.end) + (self.end - self.start).astype(np.uint64) * np.uint64(ODD[0]))
        self.hash = grams(code, self.block) if len(code) >= self.block else np.zeros(0, np.uint64)
        self.probes = np.flatnonzero(self.left[: len(self.hash)] >= self.block)

    def dealt(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each probe, and the probes' order by bucket and place."""
        bucket = (self.hash[self.probes] >> np.uint64(64 - bits)).astype(np.int64 if bits > 15 else np.int16)
        return bucket, np.argsort(bucket, kind="stable")

    def extended(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts of the windows that hold a hit, both halves' hashes, whether it is the first of its words here)."""
        hit = np.zeros(len(self.hash) + 1, np.int32)
        hit[self.probes[hits]] = 1
        upto = np.r_[0, np.cumsum(hit)]
        starts = np.flatnonzero(self.left >= self.window)
        reach = self.window - self.block
        starts = starts[upto[starts + reach + 1] > upto[starts]]
        a, b = self.hash[starts], self.hash[starts + reach]
        order = np.lexsort((starts, b, a))
        first = np.ones(len(starts), bool)
        first[order[1:]] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
        return starts, a, b, first

    def cut(self, struck: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """For each text the number of its words, of those that the windows at ``struck`` cover, and the others' bytes."""
        edge = np.zeros(len(self.doc) + 1, np.int64)
        np.add.at(edge, struck, 1)
        np.add.at(edge, struck + self.window, -1)
        kept = np.cumsum(edge[:-1]) == 0
        gone = np.bincount(self.doc[~kept], minlength=len(self.sizes))
        span = np.zeros(len(self.data) + 1, np.int8)  # bytes of kept words, each with the white space after it
        span[self.start[kept]] = 1
        span[self.end[kept] + 1] -= 1
        mask = np.cumsum(span[:-1], dtype=np.int8) > 0
        out = np.where(SPACE[self.data], 0x20, self.data)[mask].tobytes()
        ends = np.cumsum(mask)[np.cumsum(self.sizes + 1) - 1] if len(self.sizes) else []
        at = 0
        for n, m, end in zip(self.n.tolist(), gone.tolist(), np.asarray(ends).tolist()):
            yield n, m, out[at : max(at, end - 1)]  # without the space after the last word
            at = end


def in_chunks(size: int):
    """(doc_id, bytes) to rows of about ``size`` bytes: chunk, ids, digests and sizes of its texts in order, their bytes."""
    schema = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("n_bytes", pa.int64()), ("data", pa.binary())])

    def row(number: int, held: list[tuple]) -> pa.RecordBatch:
        held.sort(key=lambda x: x[:3])
        parts = [x[3] for x in held]
        data = b" ".join([*parts, b""])
        columns = [[number], [[i if known else None for known, i, _, _ in held]], [[x[2] for x in held]], [[len(p) for p in parts]], [len(data)], [data]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, total = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_buffer().to_pybytes()
                digest = int.from_bytes(hashlib.sha256(text).digest()[:8], "big", signed=True)
                held.append((doc_id is not None, doc_id or 0, digest, text))
                total += len(text) + 1
                if total >= size:
                    yield row(number, held)
                    number, held, total = number + 1, [], 0
        if held:
            yield row(number, held)

    return run


def probes_of(window: int, bits: int):
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("codes", pa.binary()), ("blocks", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for chunk, sizes, data in zip(*(batch.column(c) for c in range(3))):
                w = Words(data.as_buffer().to_pybytes(), sizes.values.to_numpy(), window, sums)
                bucket, order = w.dealt(bits)
                at, bucket = w.probes[order], bucket[order]
                codes = (w.hash[at] << np.uint64(bits) >> np.uint64(32)).astype("<u4")
                block = w.place[at] % w.block == 0
                rows = [(int(bucket[a]), chunk.as_py(), b - a, codes[a:b].tobytes(), np.packbits(block[a:b]).tobytes()) for a, b in cuts(bucket)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def cuts(keys: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    if not len(keys):
        return []
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]).tolist()
    return list(zip(new, [*new[1:], len(keys)]))


ANSWERS = pa.schema([("chunk", pa.int64()), ("kind", pa.int8()), ("bucket", pa.int32()), ("bits", pa.binary())])


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each bucket; buckets come one after another."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1]["bucket"] != row["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def answered(kind: int, rows: list[dict], yes: np.ndarray) -> Iterator[pa.RecordBatch]:
    at, out = 0, []
    for r in rows:
        part = yes[at : at + r["n"]]
        at += r["n"]
        if part.any():
            out.append((r["chunk"], kind, r["bucket"], np.packbits(part).tobytes()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ANSWERS)], schema=ANSWERS)


def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which probes hit a reference block of another place."""
    for rows in by_bucket(batches):
        codes = np.concatenate([np.frombuffer(r["codes"], "<u4") for r in rows])
        block = np.concatenate([np.unpackbits(np.frombuffer(r["blocks"], np.uint8), count=r["n"]) for r in rows]) > 0
        index = np.unique(codes[block])
        if not len(index):
            continue
        at = np.minimum(np.searchsorted(index, codes), len(index) - 1)
        found = index[at] == codes
        times = np.bincount(at[found], minlength=len(index))
        yield from answered(0, rows, found & (times[at] > 1))


def hits_of(w: Words, answers: list[dict], bits: int) -> np.ndarray:
    """Which probes hit, from the answers of kind 0."""
    bucket, order = w.dealt(bits)
    hits, sorted_bucket = np.zeros(len(order), bool), bucket[order]
    for r in answers:
        if r["kind"] == 0:
            a, b = np.searchsorted(sorted_bucket, [r["bucket"], r["bucket"] + 1])
            hits[order[a:b]] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=b - a) > 0
    return hits


def sent(w: Words, answers: list[dict], bits: int, groups: int):
    """(starts, a, b, first here or not, places of those first here in order of their bucket, that bucket)"""
    starts, a, b, first = w.extended(hits_of(w, answers, bits))
    at = np.flatnonzero(first)
    bucket = (mixed(b[at], a[at]) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return starts, a, b, first, at[order], bucket[order]


def windows_of(window: int, bits: int, groups: int):
    """(chunk, sizes, data, ids, digests, answers) to the windows around hits, by bucket."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("ids", longs), ("digests", longs), ("times", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for chunk, sizes, data, ids, digests, answers in zip(*(batch.column(c) for c in range(6))):
                w = Words(data.as_buffer().to_pybytes(), sizes.values.to_numpy(), window, sums)
                starts, a, b, _, at, bucket = sent(w, answers.as_py() or [], bits, groups)
                ids, digests = ids.as_py(), digests.as_py()
                rows = []
                for i, j in cuts(bucket):
                    part = at[i:j]
                    docs, times = np.unique(w.doc[starts[part]], return_counts=True)
                    rows.append((int(bucket[i]), chunk.as_py(), j - i, a[part].tobytes(), b[part].tobytes(), [ids[d] for d in docs], [digests[d] for d in docs], times))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which windows also start in an earlier text of another chunk."""
    for rows in by_bucket(batches):
        a, b = (np.concatenate([np.frombuffer(r[c], np.uint64) for r in rows]) for c in "ab")
        ids = [i for r in rows for i in r["ids"]]
        known, number = np.array([i is not None for i in ids]), np.array([i or 0 for i in ids], np.int64)
        digest = np.array([d for r in rows for d in r["digests"]], np.int64)
        chunk = np.repeat([r["chunk"] for r in rows], [len(r["ids"]) for r in rows])
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((chunk, digest, number, known))] = np.arange(len(ids))
        rank = np.repeat(rank, np.concatenate([r["times"] for r in rows]))
        order = np.lexsort((rank, b, a))
        later = np.zeros(len(a), bool)
        later[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
        yield from answered(1, rows, later)


def cut_out(window: int, bits: int, groups: int, with_text: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.string())] * with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for sizes, data, ids, answers in zip(*(batch.column(c) for c in range(1, 5))):
                w = Words(data.as_buffer().to_pybytes(), sizes.values.to_numpy(), window, sums)
                answers = answers.as_py() or []
                starts, _, _, first, at, bucket = sent(w, answers, bits, groups)
                struck = ~first
                for r in answers:
                    if r["kind"] == 1:
                        i, j = np.searchsorted(bucket, [r["bucket"], r["bucket"] + 1])
                        struck[at[i:j]] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=j - i) > 0
                rows = [(i, n, m, hashlib.sha256(kept).hexdigest()) + (kept.decode(),) * with_text for i, (n, m, kept) in zip(ids.as_py(), w.cut(starts[struck]))]
                for k in range(0, len(rows), 2048):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 2048]), schema)], schema=schema)

    return run


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, chunk: int = CHUNK, buckets: int = BUCKETS, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (and on request kept, the remaining words)."""
    if window < 2:
        raise ValueError("a window has two words or more")
    spark = docs.sparkSession
    small_batches(spark)
    plain = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    size = plain._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()  # of the files, where known
    parts = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // SCAN if int(size) < 1 << 60 else 0))
    name = f"texts_{uuid.uuid4().hex}"
    cut = plain.mapInArrow(in_chunks(chunk), "chunk long, ids array<long>, digests array<long>, sizes array<long>, n_bytes long, data binary")
    cut.write.bucketBy(parts, "chunk").option("path", f"{shared_dir(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
    cut = spark.table(name)
    total = cut.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    bits = max(buckets.bit_length() - 1, (total // 2 // PROBES).bit_length())  # a word has two bytes with its space, or more
    groups = max(buckets // 4, total // 8 // WINDOWS)

    def joined(answers: DataFrame) -> DataFrame:
        lists = answers.repartition(parts, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "bits")).alias("answers"))
        return cut.join(lists.hint("shuffle_hash"), "chunk", "left").select("chunk", "sizes", "data", "ids", "digests", "answers")

    def dealt(rows: DataFrame, n: int) -> DataFrame:
        return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 8), "bucket").sortWithinPartitions("bucket")

    answer = "chunk long, kind byte, bucket int, bits binary"
    probes = cut.select("chunk", "sizes", "data").mapInArrow(probes_of(window, bits), "bucket int, chunk long, n int, codes binary, blocks binary")
    hits = staged(dealt(probes, 1 << bits).mapInArrow(look_up, answer), "hits")
    windows = joined(hits).mapInArrow(windows_of(window, bits, groups), "bucket int, chunk long, n int, a binary, b binary, ids array<long>, digests array<long>, times array<int>")
    later = staged(dealt(windows, groups).mapInArrow(strike, answer), "later")
    done = joined(hits.unionByName(later)).select("chunk", "sizes", "data", "ids", "answers")
    return done.mapInArrow(cut_out(window, bits, groups, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
win as (select doc_id, i, md5(array_to_string(ws[i:i+19], ' ')) as s from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from w where len(ws) >= 20)),
late as (select doc_id, i from (select *, row_number() over (partition by s order by doc_id, i) as k from win) where k > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from late),
word as (select doc_id, unnest(ws) as x, unnest(range(1, len(ws) + 1)) as p from w),
kept as (select doc_id, string_agg(x, ' ' order by p) as t, count(*) as n from word anti join gone using (doc_id, p) group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (doc_id)
"""
