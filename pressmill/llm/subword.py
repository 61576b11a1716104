"""Supervised subword embeddings: the model behind the quality and toxicity classifiers.

A text is a bag of hashed features: its white-space words, the character n-grams of each word with its borders, and for
each word whether it repeats the one before it (two reserved buckets).
Every feature owns an embedding; their average goes through a linear softmax. Embeddings and softmax are trained
jointly by stochastic gradient descent with per-coordinate steps, in numpy, on a bounded sample of labelled rows (the
bound is a parameter; features of the sample are made in tasks, and one task trains on them). Since softmax(mean(E) W + b) only needs E W, the
trained model is shipped as one number a feature, a table of fixed size, and whole texts are scored in Arrow batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pressmill.llm.common import small_batches

GRAMS = (3, 4, 5)
PRIME = 0x9E3779B97F4A7C15
#: Bytes hashed at once; a longer text is taken in pieces cut at white space, never inside a word, and the last word of a piece
#: is known to the next, so that its features are as they were.
PIECE = 1 << 19
WHITE = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    dim: int = 8
    lowercase: bool = False
    per_class: int = 2500  # labelled rows of each class that training may use
    epochs: int = 10
    step: float = 0.5
    batch: int = 32
    seed: int = 7
    damping: float = 1e-4  # of the per-coordinate steps: features seen seldom move little


def byte_table(lowercase: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[[9, 10, 11, 12, 13]] = 32
    if lowercase:
        table[65:91] += 32
    return table


def pieces(texts: list[bytes], limit: int = PIECE) -> Iterator[tuple[list[int], list[int], list[int], bytes]]:
    """Runs of padded texts of about ``limit`` bytes: the owners of its parts, where each part starts, the starts of those that
    begin a text, and the bytes."""
    owners, starts, fresh, parts, size = [], [], [], [], 0
    for owner, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > limit:
                cut = max(text.rfind(c, at + 1, at + limit) for c in WHITE)
                if cut <= at:  # a word longer than a piece stays whole
                    cut = min((k for c in WHITE if (k := text.find(c, at + limit)) >= 0), default=end)
                end = cut
            owners.append(owner)
            starts.append(size)
            if at == 0:
                fresh.append(size)
            parts.append(b" " + text[at:end] + b" ")
            size += len(parts[-1])
            at = end
            if size >= limit:
                yield owners, starts, fresh, b"".join(parts)
                owners, starts, fresh, parts, size = [], [], [], [], 0
            if at >= len(text):
                break
    if owners:
        yield owners, starts, fresh, b"".join(parts)


class Hasher:
    def __init__(self, settings: Settings):
        self.table, self.shift = byte_table(settings.lowercase), np.uint64(64 - settings.bits)
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.last: np.ndarray = np.zeros(0, np.uint64)  # the last word's hash, for the piece that goes on with its text

    def _need(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, PRIME, np.uint64)])
            self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(PRIME, -1, 1 << 64), np.uint64)])

    def __call__(self, data: bytes, fresh: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, buckets) for words and for each n-gram length; a gram may only start or end with the space. At the
        places ``fresh`` a text begins, whose first word has no word before it."""
        b = self.table[np.frombuffer(data, np.uint8)]
        space = b == 32
        x = b.astype(np.uint64) + np.uint64(1)
        before = np.cumsum(space, dtype=np.int32)
        for n in GRAMS:
            m = len(b) - n + 1
            if m < 1:
                continue
            at = np.flatnonzero(before[n - 2 : n - 2 + m] == before[:m])
            h = x[at]
            for k in range(1, n):
                h = h * np.uint64(PRIME) + x[at + k]
            h ^= h >> np.uint64(29)
            yield at, (h * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)) >> self.shift
        self._need(len(b))
        edge = np.diff(space.view(np.int8))
        first, last = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1)
        total = np.cumsum(x * self.powers[: len(x)])
        h = (total[last] - total[first - 1]) * self.inverses[first]
        h ^= h >> np.uint64(31)
        yield first, (h * np.uint64(0x94D049BB133111EB)) >> self.shift
        # buckets 0 and 1: another word than before, the same word again
        if fresh and fresh[0] == 0:
            self.last = self.last[:0]
        opens = np.zeros(len(first) + 1, bool)
        opens[np.searchsorted(first, fresh)] = True  # a text without words leaves this to the text after it
        chain = np.r_[self.last, h]
        has_before = ~opens[: len(first)]
        if not len(self.last):
            has_before[:1] = False
            chain = np.r_[np.zeros(1, np.uint64), h]
        same = (chain[1:] == chain[:-1])[has_before]
        self.last = h[-1:] if len(h) else self.last
        if len(fresh) and np.searchsorted(first, fresh[-1]) == len(first):
            self.last = self.last[:0]  # the last text has no word yet
        yield first[has_before], same.astype(np.uint64)


def featurize(settings: Settings):
    """(label, text) rows to (label, distinct buckets, count of each), as bytes of int32 and uint32: what training shares out."""
    schema = pa.schema([("label", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        hasher = Hasher(settings)
        for batch in batches:
            ids, counts = [], []
            for value in batch.column(1):
                found = [bucket for _, _, fresh, data in pieces([value.as_buffer().to_pybytes()]) for _, bucket in hasher(data, fresh)]
                unique, count = np.unique(np.concatenate(found), return_counts=True)
                ids.append(unique.astype(np.int32).tobytes())
                counts.append(count.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], schema=schema)

    return run


@dataclass
class Model:
    settings: Settings
    weights: np.ndarray  # of each feature, in the difference of the two logits
    bias: float


def fit(labels: np.ndarray, ids: list[np.ndarray], counts: list[np.ndarray], positives: int, negatives: int, s: Settings) -> Model:
    """Train on the sample; a fifth of it chooses the epoch and calibrates. ``positives`` and ``negatives`` are the counts
    of all labelled rows, to which the bias is set back."""
    prior = np.log((positives + 1) / (negatives + 1))
    if len(set(labels.tolist())) < 2 or len(labels) < 20:
        return Model(s, np.zeros(1 << s.bits, np.float32), float(prior))
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(labels))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]

    def share(i):
        return (counts[i] / max(1, counts[i].sum(dtype=np.int64))).astype(np.float32)

    def pack(rows):
        flat = np.concatenate([ids[i] for i in rows])
        unique, inverse = np.unique(flat, return_inverse=True)
        sizes = np.array([len(ids[i]) for i in rows])
        row = np.repeat(np.arange(len(rows)), sizes)
        return unique, inverse.astype(np.int32), row.astype(np.int16), np.concatenate([share(i) for i in rows]), labels[rows]

    batches = [pack(train[i : i + s.batch]) for i in range(0, len(train), s.batch)]
    known = np.zeros(1 << s.bits, bool)  # features of the sample; others weigh nothing
    for unique, *_ in batches:
        known[unique] = True
    e = rng.standard_normal((1 << s.bits, s.dim), np.float32)
    e *= np.float32(0.1) * known[:, None]
    e2 = np.full((1 << s.bits, s.dim), s.damping, np.float32)
    w, w2 = rng.normal(0, 0.5, (s.dim, 2)), np.full((s.dim, 2), 1e-6)
    c, c2 = np.zeros(2), np.full(2, 1e-6)
    best, kept, flat_held = np.inf, None, [(ids[i].copy(), share(i)) for i in held]
    y_held = labels[held]
    ids.clear(), counts.clear()  # packed above; the driver needs no second copy
    bias_mix = np.log(max(1, (labels == 1).sum()) / max(1, (labels == 0).sum()))

    def calibrated(z):
        a, b0 = 1.0, 0.0
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(a * z + b0, -30, 30)))
            g, v = p - y_held, np.maximum(p * (1 - p), 1e-6)
            hess = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
            move = np.linalg.solve(hess, [(g * z).sum(), g.sum()])
            a, b0 = a - np.clip(move[0], -1, 1), b0 - np.clip(move[1], -2, 2)
        p = np.clip(1 / (1 + np.exp(-np.clip(a * z + b0, -30, 30))), 1e-6, 1 - 1e-6)
        return a, b0, -(y_held * np.log(p) + (1 - y_held) * np.log(1 - p)).mean()

    for epoch in range(s.epochs):
        step = s.step * (1 - epoch / s.epochs)
        for k in rng.permutation(len(batches)):
            unique, inverse, row, share, y = batches[k]
            own = e[unique]
            n = len(y)
            mean = np.stack([np.bincount(row, own[inverse, d] * share, n) for d in range(s.dim)], 1)
            z = mean @ w + c
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y] -= 1
            g_w, g_c, g_mean = mean.T @ p, p.sum(0), (p @ w.T)[row] * share[:, None]
            g_e = np.stack([np.bincount(inverse, g_mean[:, d], len(unique)) for d in range(s.dim)], 1)
            e2[unique] += g_e * g_e
            e[unique] = own - step * g_e / np.sqrt(e2[unique])
            w2 += g_w * g_w
            w -= 0.2 * step * g_w / np.sqrt(w2)
            c2 += g_c * g_c
            c -= 0.2 * step * g_c / np.sqrt(c2)
        joint = e @ (w[:, 1] - w[:, 0])
        a, b0, loss = calibrated(np.array([joint[i] @ v for i, v in flat_held]) + c[1] - c[0])
        if loss < best:
            best, kept = loss, ((a * joint).astype(np.float32), float(a * (c[1] - c[0]) + b0 - bias_mix + prior))
    return Model(s, *kept)


def train(docs: DataFrame, labels: DataFrame, label_col: str, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from labelled rows whose crc32(id as text) mod 5 is not 0: at most ``per_class`` of each class, taken in the
    order of a hash of the id. Null ids and labels are left out; of an id labelled twice the larger label counts."""
    small_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label in (0, 1) and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).cache()
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.per_class) for y in (0, 1)]
    sample = share[0].unionByName(share[1])
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    features = plain.join(F.broadcast(sample), "doc_id").select("label", "text").mapInArrow(featurize(s), "label int, ids binary, counts binary")
    # the sample is bounded, so one task trains on it, and the driver gets the table of weights alone
    made = features.repartition(1).mapInArrow(fitted(counts.get(1, 0), counts.get(0, 0), s), "weights binary, bias double").collect()
    known.unpersist()
    if not made:
        return fit(np.zeros(0, np.int64), [], [], counts.get(1, 0), counts.get(0, 0), s)
    return Model(s, np.frombuffer(bytes(made[0]["weights"]), np.float32), made[0]["bias"])


def fitted(positives: int, negatives: int, s: Settings):
    """Rows of ``featurize`` to one row, the trained model."""

    def run(batches):
        held = list(batches)
        labels = np.concatenate([b.column(0).to_numpy() for b in held]) if held else np.zeros(0, np.int64)
        ids = [np.frombuffer(v.as_buffer(), np.int32) for b in held for v in b.column(1)]
        counts = [np.frombuffer(v.as_buffer(), np.uint32) for b in held for v in b.column(2)]
        # a fixed order, whatever the order of the tasks
        order = np.array(sorted(range(len(ids)), key=lambda i: (labels[i], hashlib.sha256(ids[i].tobytes()).digest())), np.int64)
        model = fit(labels[order].astype(np.int64), [ids[i] for i in order], [counts[i] for i in order], positives, negatives, s)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], names=["weights", "bias"])

    return run


def scored(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """All rows and columns, and in column ``name`` the probability of label 1 of every whole text; an empty or null text
    gets the prior."""
    spark = docs.sparkSession
    small_batches(spark)
    weights, bias, settings = spark.sparkContext.broadcast(model.weights), model.bias, model.settings
    at_text = docs.columns.index(text_col)

    def run(batches):
        hasher, w = Hasher(settings), weights.value
        for batch in batches:
            texts = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column(at_text)]
            total, count = np.zeros(len(texts)), np.zeros(len(texts))
            for owners, starts, fresh, data in pieces(texts):
                for at, bucket in hasher(data, fresh):
                    bounds = np.searchsorted(at, [*starts, len(data)])
                    sums = np.concatenate([[0.0], np.cumsum(w[bucket], dtype=np.float64)])[bounds]
                    np.add.at(total, owners, np.diff(sums))
                    np.add.at(count, owners, np.diff(bounds))
            z = np.clip(total / np.maximum(count, 1) + bias, -30, 30)
            yield batch.append_column(name, pa.array(1 / (1 + np.exp(-z))))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    return scored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), model, "score").select("doc_id", "score")


def judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id",
        F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
