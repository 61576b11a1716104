"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

Documents are tokenized in Arrow batches and cut into pieces, which are staged. Only the histogram of their lengths (at
most ``capacity`` numbers) and the size of each (length, salt) cell reach the driver. There the configuration program
"fewest sequences so that every length is placed as often as it occurs" is solved by multiplicative weights: each round
prices the lengths, a knapsack dynamic program finds the configurations worth most, and lengths used beyond their
share lose weight, the others gain. The mean of the rounds is rounded down; what is left is placed by best fit
decreasing, on counts as well. The plan says, for each length, which ranks go to which sequences and offsets; a window
over (length, salt) ranks the pieces, so no length, however frequent, is in one task.

Defined results: null text counts as empty and is the end id alone; pieces of full length have a sequence each; a
document repeated as a row is packed as often; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.llm.common import small_batches, staged, table, texts

CAPACITY = 1024
END_ID = 2
SALTS = 256
ROUNDS = 400
#: Share of the capacity that a configuration must fill to be rounded into sequences; the rest goes to best fit.
FULL = 0.999
#: Configurations taken from one pricing, those led by the lengths that are furthest behind.
COLUMNS = 32
#: Entries of a worker's chunk cache before it starts anew.
CACHE = 250_000
SPECIAL = "<|endoftext|>"


class OddSpace(Exception):
    """A chunk next to other white space: it can't be encoded by itself."""


class ChunkCache(dict):
    """Ids (as bytes of uint32) of a chunk between single spaces. A space followed and preceded by other than white
    space always starts a pre-token, so a text's ids are those of its chunks put together."""

    def __init__(self, model: str):
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(model)
        with open(model.removesuffix(".json") + ".tiktoken", "rb") as lines:  # the same vocabulary, as ranks
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if SPECIAL in text:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if chunk in ("", " ") or chunk[1:2].isspace() or chunk[-1].isspace() or chunk[0].isspace() and chunk[0] != " ":
            raise OddSpace
        if len(self) > CACHE:
            self.clear()
        found = self[chunk] = self.encode(chunk)
        return found

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            first, *rest = text.split(" ")
            return b"".join([self[first] if first else b"", *map(self.__getitem__, [" " + c for c in rest])])
        except OddSpace:
            return self.encode(text)



def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all but the first have full length."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenized(docs: DataFrame, model: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches):
        import sys

        kept = sys.modules.setdefault("_chunk_caches", type(sys)("_chunk_caches")).__dict__  # lives as long as the worker
        cache = kept.get(model) or kept.setdefault(model, ChunkCache(model))
        uid = (TaskContext.get().partitionId() << 36) if TaskContext.get() else 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = cache.ids(text) + end
                for piece, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((uid, doc_id, piece, start, length, zlib.crc32(part)) + (np.frombuffer(part, "<i4").tolist(),) * with_ids)
                    uid += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return texts(docs).mapInArrow(run, "uid long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def priced(prices: np.ndarray, items: np.ndarray, capacity: int, forced: np.ndarray) -> list[list[int]]:
    """For each item of ``forced`` the items of the configuration worth most of which it is the last: one knapsack
    dynamic program over the items, each used once, prices them all."""
    best, taken = np.zeros(capacity + 1), np.zeros((len(items), capacity + 1), bool)
    for i, (size, price) in enumerate(zip(items.tolist(), prices.tolist())):
        value = best[: capacity + 1 - size] + price
        taken[i, size:] = better = value > best[size:]
        np.copyto(best[size:], value, where=better)
    found = []
    for last in forced.tolist():
        chosen, room, i = [last], capacity - int(items[last]), last - 1
        while i >= 0 and room:
            below = np.flatnonzero(taken[: i + 1, room])  # the next item down that this room takes
            if not len(below):
                break
            i = int(below[-1])
            chosen.append(i)
            room -= int(items[i])
            i -= 1
        found.append(chosen)
    return found


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit decreasing on counts: open sequences of the same content are one entry with its number."""
    rooms: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]

    def put(content: tuple, room: int, times: int) -> None:
        if times:
            rooms[room][content] = rooms[room].get(content, 0) + times

    for length in range(capacity, 0, -1):
        k = int(left[length])
        while k:
            room = next((r for r in range(length, capacity) if rooms[r]), None)
            if room is None:
                per = capacity // length
                put(((length, per),), capacity - per * length, k // per)
                if k % per:
                    put(((length, k % per),), capacity - k % per * length, 1)
                break
            content, times = rooms[room].popitem()
            fits = min(room // length, max(1, k // times))
            used = min(times, k // fits)
            put(content, room, times - used)
            put((*content, (length, fits)), room - fits * length, used)
            k -= fits * used
    merged: list[tuple[dict[int, int], int]] = []
    for room in rooms:
        for content, times in room.items():
            config: dict[int, int] = {}
            for length, n in content:
                config[length] = config.get(length, 0) + n
            merged.append((config, times))
    return merged


def plan(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """(configuration, how many sequences have it), placing each length exactly counts[length] times."""
    left = counts.astype(np.int64).copy()
    left[capacity:] = 0
    lengths = np.flatnonzero(left)
    chosen: list[tuple[dict[int, int], int]] = []
    if len(lengths) > 1:
        n = left[lengths].astype(float)
        sequences = (lengths * n).sum() / capacity
        # a configuration holds a length about as often as its share asks for, so that the rounding finds enough of each
        bound = np.minimum(np.ceil(2 * n / sequences), np.minimum(n, capacity // lengths)).astype(int)
        parts = [(i, 1 << k) for i, most in enumerate(bound) for k in range(int(most).bit_length()) if (1 << k) <= most]
        owner, times_each = np.array(parts).T
        items = lengths[owner] * times_each
        keep = items <= capacity
        owner, times_each, items = owner[keep], times_each[keep], items[keep]
        share, used, mass = n / n.sum(), np.zeros(len(lengths)), {}
        columns = 0
        for _ in range(rounds):
            behind = 1 - used / np.maximum(used.sum() * share, 1e-9) if used.any() else np.zeros(len(lengths))
            weight = np.exp(0.05 * np.clip(behind, -2, 1))
            forced = np.argsort(-(behind * lengths / capacity)[owner], kind="stable")[:COLUMNS]
            for picked in priced((items / capacity) * weight[owner], items, capacity, forced):
                a = np.bincount(owner[picked], times_each[picked], len(lengths))
                used += a
                columns += 1
                key = tuple((int(lengths[i]), int(a[i])) for i in np.flatnonzero(a))
                mass[key] = mass.get(key, 0) + 1
        scale, due = sequences / columns, 0.0  # what rounding down leaves goes to the next configuration
        for key, m in sorted(mass.items(), key=lambda x: (sum(v * a for v, a in x[0]), x[1]), reverse=True):
            if sum(v * a for v, a in key) < FULL * capacity:
                continue
            due += m * scale
            times = min(int(due), min(int(left[v]) // a for v, a in key))
            due -= int(due)
            if times > 0:
                chosen.append((dict(key), times))
                for v, a in key:
                    left[v] -= a * times
    return chosen + best_fit(left, capacity)


def intervals(chosen: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, copies in a sequence, first offset), by first rank."""
    found: dict[int, list] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for config, times in chosen:
        offset = 0
        for length in sorted(config, reverse=True):
            a = config[length]
            found.setdefault(length, []).append((rank.get(length, 0), sequence, a, offset))
            rank[length] = rank.get(length, 0) + a * times
            offset += a * length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, rounds: int = ROUNDS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = staged(tokenized(docs, tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"), capacity, end_id, with_ids), "pieces")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    full = pieces.where(F.col("length") == capacity).select(*out, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col("length") < capacity).withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    cells = short.groupBy("length", "salt").agg(F.count("*").alias("n")).toArrow()
    sizes = np.zeros((capacity + 1, SALTS), np.int64)
    np.add.at(sizes, (cells.column(0).to_numpy(), cells.column(1).to_numpy()), cells.column(2).to_numpy())
    shared = spark.sparkContext.broadcast((np.cumsum(sizes, axis=1) - sizes, intervals(plan(sizes.sum(axis=1), capacity, rounds))))
    ranked = short.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("uid")).cast("long") - 1)

    def place(batches):
        before, places = shared.value
        for batch in batches:
            length, salt, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "salt", "rank"))
            rank = rank + before[length, salt]
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for v in np.unique(length):
                own, rows = length == v, places[int(v)]
                at = np.searchsorted(rows[:, 0], rank[own], "right") - 1
                over = rank[own] - rows[at, 0]
                sequence[own] = rows[at, 1] + over // rows[at, 2]
                offset[own] = rows[at, 3] + over % rows[at, 2] * v
            kept = [batch.column(batch.schema.get_field_index(c)) for c in out]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*out, "sequence_id", "offset"])

    placed = ranked.select(*out, "salt", "rank").mapInArrow(place, full.schema)
    return placed.unionByName(full)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
