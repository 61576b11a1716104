"""Grouping of spelling variants with a trie over letter-group counts.

Letters fall into groups; a word's vector says how many of its letters are in each. One inserted or deleted letter changes
one count by one, a replaced one two counts or none. The trie orders words by one count after another; a search walks down
with a budget of one surplus and one deficit, so it meets only words whose vectors are that near. At the leaves words that
share the first or the second half are verified letter by letter: one edit leaves one half as it is.

Each pair is found once: the shorter word searches for the longer one; of equal length, the word that has less in the
first of the two counts that differ searches; within a leaf, the lesser one. The trie is sharded by its first levels, as
many as make no shard too large: a word is kept in its own shard and asks in those that its budget reaches, which is
settled by arithmetic. Shards give numbers and the best near word for each word, never lists of pairs.

Defined results: null texts have no words; a null id counts as empty in the planted misspellings; rows that repeat count
again; an empty table gives an empty table; words have any length; ties of the most frequent near word go to the least in
code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import discard, small_batches, staged, table, texts
from pressmill.llm.repeats import ODD, scramble

#: One misspelling is planted in so many runs; words have so many letters and occurrences at least; a form has so many
#: times the word's occurrences at least.
PLANTED, LETTERS, TIMES, RATIO = 97, 5, 3, 2
RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Letter groups, a level of the trie each; all other letters are the last level.
GROUPS = ("e", "a", "i", "o", "n", "s", "r", "t", "l", "d", "u", "c", "m", "p", "gq", "bvw", "fhk", "jxyz", "áéíóúü")
LEVELS = len(GROUPS) + 1
LEVEL_OF = np.full(256, LEVELS - 1)
for _k, _g in enumerate(GROUPS):
    LEVEL_OF[list(_g.encode("latin-1"))] = _k
#: Words in a shard, words searched together, and different words that a task counts before it hands them on.
SHARD, TOGETHER, HELD = 50_000, 20_000, 400_000


def tally(letters: int, planted: int):
    """(doc_id, text) to (word, n), words of ``letters`` letters or more, misspellings planted."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def told(total: dict) -> Iterator[pa.RecordBatch]:
        words = list(total)
        for k in range(0, len(words), 50_000):
            part = words[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([total[w] for w in part], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        get = total.get
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_buffer().to_pybytes().translate(LOWER).decode()
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(RUN.findall(text)).items():
                    if len(word) >= letters:
                        h = zlib.crc32(word.encode(), seed)
                        if not h % planted:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < letters:
                                continue
                        total[word] = get(word, 0) + n
            if len(total) > HELD:
                yield from told(total)
                total.clear()
        yield from told(total)

    return run


def vectors(words: list[bytes]) -> np.ndarray:
    """Letters in each group, a row for each word."""
    data = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(owner * LEVELS + LEVEL_OF[data], minlength=len(words) * LEVELS).reshape(len(words), LEVELS)


def prefixes(v: np.ndarray, depth: int) -> list[bytes]:
    flat = np.ascontiguousarray(v[:, :depth], dtype=">i4").tobytes()
    return [flat[k : k + 4 * depth] for k in range(0, len(flat), 4 * depth)]


def sizes_at(depth: int):
    schema = pa.schema([("shard", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(prefixes(vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()]), depth))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], schema=schema)

    return run


def routed(depth: int):
    """(word, n) to (shard, state, word, n): the word in its own shard (state 0), and its search in each shard where the first
    levels have one letter more (1), or one more and later one less (2)."""
    schema = pa.schema([("shard", pa.binary()), ("state", pa.int8()), ("word", pa.string()), ("n", pa.int64())])
    moves = [(0, ())] + [(1, ((g, 1),)) for g in range(depth)] + [(2, ((g, 1), (h, -1))) for g in range(depth) for h in range(g + 1, depth)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()])
            for state, move in moves:
                to, able = v[:, :depth].copy(), np.ones(len(v), bool)
                for g, step in move:
                    to[:, g] += step
                    able &= to[:, g] >= 0
                at = pa.array(np.flatnonzero(able))
                shard = prefixes(to[able], depth)
                if shard:
                    yield pa.RecordBatch.from_arrays([pa.array(shard, pa.binary()), pa.array(np.full(len(shard), state, np.int8)), batch.column(0).take(at), batch.column(1).take(at)], schema=schema)

    return run


class Trie:
    """Words by their counts, level after level; ``root`` says in which shard each word is, the levels are those below it.
    Nodes of a level are numbered in order, and a child is found by (node, count) among the next level's."""

    def __init__(self, root: np.ndarray, v: np.ndarray):
        self.width = int(v.max(initial=0)) + 2
        self.children, node = [], root.astype(np.int64)
        for column in v.T:
            key, node = np.unique(node * self.width + column, return_inverse=True)
            self.children.append(key)
        self.leaf = node

    def search(self, root: np.ndarray, state: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, leaf, state at the leaf) of all walks that spend one surplus at most and after it one deficit."""
        query, node, spent = np.arange(len(root)), root.astype(np.int64), state.astype(np.int64)
        for children, column in zip(self.children, v.T):
            count, steps = column[query], []
            for change, allowed, after in ((0, None, None), (1, spent == 0, 1), (-1, spent == 1, 2)):
                rows = np.arange(len(query)) if allowed is None else np.flatnonzero(allowed)
                to = count[rows] + change
                rows, to = rows[(to >= 0) & (to < self.width)], to[(to >= 0) & (to < self.width)]
                key = node[rows] * self.width + to
                at = np.minimum(np.searchsorted(children, key), len(children) - 1)
                hit = children[at] == key
                steps.append((query[rows[hit]], at[hit], spent[rows[hit]] if after is None else np.full(hit.sum(), after)))
            query, node, spent = (np.concatenate(x) for x in zip(*steps))
        return query, node, spent


def joined(leaf: np.ndarray, half: np.ndarray) -> np.ndarray:
    return scramble(leaf.astype(np.uint64) * np.uint64(ODD[1]) + half)


def hashed(parts: Iterator[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(hash, parts), np.int64, n).astype(np.uint64)


def one_edit(x: bytes, y: bytes) -> bool:
    """Whether y is x with exactly one letter replaced, or inserted."""
    if len(x) == len(y):
        return sum(map(ne, x, y)) == 1
    at = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return len(y) == len(x) + 1 and x[at:] == y[at + 1 :]


def near_pairs(depth: int, words: list[bytes], root: np.ndarray, state: np.ndarray, piece: int = 4096) -> Iterator[tuple[int, int]]:
    """Pairs (row that searches, row in its shard) that are one edit apart, each once. Rows of state 0 are in their shard."""
    v = vectors(words)[:, depth:]
    kept = np.flatnonzero(state == 0)
    if not len(kept):
        return
    trie, leaf = Trie(root[kept], v[kept]), None
    leaf = trie.leaf
    own = [words[k] for k in kept.tolist()]
    n = len(own)
    # halves as a word of equal length, and one shorter by a letter, would have them
    halves = {
        False: (hashed((w[: len(w) // 2] for w in own), n), hashed((w[len(w) // 2 :] for w in own), n)),
        True: (hashed((w[: (len(w) - 1) // 2] for w in own), n), hashed((w[(len(w) - 1) // 2 + 1 :] for w in own), n)),
    }
    tables = {}
    for longer, pair in halves.items():
        for k, half in enumerate(pair):
            key = joined(leaf, half)
            order = np.argsort(key, kind="stable")
            tables[longer, k] = key[order], order
    for a in range(0, len(words), piece):
        part = words[a : a + piece]
        query, at, spent = trie.search(root[a : a + piece], state[a : a + piece], v[a : a + piece])
        asked = hashed((w[: len(w) // 2] for w in part), len(part)), hashed((w[len(w) // 2 :] for w in part), len(part))
        found = []
        for longer in (False, True):
            rows = np.flatnonzero((spent == 1) == longer)
            for k in (0, 1):
                key, order = tables[longer, k]
                wanted = joined(at[rows], asked[k][query[rows]])
                low, high = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
                times = high - low
                q = np.repeat(query[rows], times)
                place = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
                inside = np.repeat(spent[rows] == 0, times)
                y = order[place]
                # within a leaf each pair is met twice
                found.append(((q + a) * n + y)[~inside | (kept[y] > q + a)])
        for pair in np.unique(np.concatenate(found)).tolist():
            q, y = divmod(pair, n)
            if one_edit(words[q], own[y]):
                yield q, int(kept[y])


def shard_search(depth: int):
    """(shard, state, word, n), sorted by shard, to (word, n_near, best_n, best_word) of what its shards know."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best_word", pa.string())])

    def solved(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        words = [r[2].encode("latin-1") for r in rows]
        root = np.cumsum([0, *(a[0] != b[0] for a, b in zip(rows[1:], rows))])
        state = np.array([r[1] for r in rows])
        best: dict[str, tuple] = {}
        for i, j in near_pairs(depth, words, root, state):
            for (_, _, word, _), (_, _, other, n) in ((rows[i], rows[j]), (rows[j], rows[i])):
                count, top = best.get(word, (0, (0, "")))
                best[word] = count + 1, min(top, (-n, other))
        out = [(w, c, -n, o) for w, (c, (n, o)) in best.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= TOGETHER and row[0] != held[-1][0]:
                    yield from solved(held)
                    held = []
                held.append(row)
        if held:
            yield from solved(held)

    return run


def depth_for(words: DataFrame, shard: int) -> int:
    """The least number of levels at which no shard has more than ``shard`` words; all levels where even they don't do."""
    for depth in range(3, LEVELS):
        sizes = words.select("word").mapInArrow(sizes_at(depth), "shard binary, n long").groupBy("shard").agg(F.sum("n").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= shard:
            return depth
    return LEVELS


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, n), each word once, to (word, n_near, best_n, best_word) of those that have near words."""
    depth = depth_for(words, shard)
    rows = words.select("word", "n").mapInArrow(routed(depth), "shard binary, state byte, word string, n long")
    rows = rows.repartition("shard").sortWithinPartitions("shard")
    part = rows.mapInArrow(shard_search(depth), "word string, n_near long, best_n long, best_word string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best_word").alias("word")))
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best_word"))


def roots(links: DataFrame) -> DataFrame:
    """(word, form) to (word, root): where following forms ends. Each round doubles the steps; occurrences double with
    each step, so six rounds reach the end of any chain."""
    jumps = staged(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        more = staged(jumps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(jumps)
        moved = more.where("moved").limit(1).count()
        jumps = more.drop("moved")
        if not moved:
            return jumps


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, times: int = TIMES, ratio: int = RATIO, planted: int = PLANTED, shard: int = SHARD) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that occurs ``times`` times."""
    small_batches(docs.sparkSession)
    plain = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    counted = plain.mapInArrow(tally(letters, planted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = staged(counted.where(F.col("n") >= times), "words")
    near = words.join(near_words(words, shard), "word", "left")
    form = F.col("best_n") >= ratio * F.col("n")
    near = staged(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form, F.col("best_word")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "near")
    found = near.join(roots(near.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
