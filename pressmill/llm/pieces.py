"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

The pieces come from a model file whose path is a parameter. Where the file has scores that are merge ranks and no
probabilities, the log score of rank r is taken as that of Zipf's law, -ln(r + 1) - ln(H). Space is written as the
marker U+2581, one marker is put in front, a character without a piece falls back to its UTF-8 bytes. No piece has the
marker after another character, so the best path of a text is that of its marked words, and each different word is
solved once for many texts: all new words of a batch walk the trie together in numpy, long ones by themselves.

Defined results: null counts as empty, which has no ids and decodes to empty; U+2581 in a text decodes to a space, as in
the reference library, and shows as round_trip false; texts are taken whole, whatever their length.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressmill.llm.common import small_batches, table, texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Longest word, in bytes, that is solved together with others.
LONG = 64
CACHE = 250_000


@dataclass
class Trie:
    """Double array over bytes: from state s by byte c to base[s] + c + 1 if check there is s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(keys: dict[bytes, int]) -> Trie:
        tree: list[dict[int, int]] = [{}]
        ends = {0: -1}
        for key, value in sorted(keys.items()):
            at = 0
            for c in key:
                if c not in tree[at]:
                    tree[at][c] = len(tree)
                    ends[len(tree)] = -1
                    tree.append({})
                at = tree[at][c]
            ends[at] = value
        size = 2 * len(tree) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        place, lowest = {0: 0}, [1, 1]
        for node, children in enumerate(tree):
            here = place[node]
            value[here] = ends[node]
            if not children:
                continue
            codes = np.array(sorted(children)) + 1
            b, at = -1, lowest[len(codes) > 1]
            while b < 0:  # the first place, a window at a time, where all children find free slots
                if at + 4096 + 514 > len(free):
                    grow = len(free)
                    base, check, value, free = (np.concatenate([a, np.full(grow, fill, a.dtype)]) for a, fill in ((base, 0), (check, -1), (value, -1), (free, True)))
                slots = at + np.flatnonzero(free[at : at + 4096])
                slots = slots[slots >= codes[0]]
                fits = free[(slots - codes[0])[:, None] + codes].all(1)
                if fits.any():
                    b = int(slots[fits.argmax()] - codes[0])
                    lowest[len(codes) > 1] = at
                else:
                    at += 4096
            base[here] = b
            free[b + codes] = False
            check[b + codes] = here
            for c, child in children.items():
                place[child] = b + c + 1
        end = int(np.flatnonzero(~free)[-1]) + 258
        pad = lambda a, fill: np.concatenate([a, np.full(max(0, end - len(a)), fill, a.dtype)])[:end]
        return Trie(pad(base, 0), pad(check, -1), pad(value, -1))


@dataclass
class Vocabulary:
    trie: Trie
    scores: np.ndarray
    unknown: float
    surface: list[bytes]  # of each id when decoded, the marker already a space
    byte_ids: np.ndarray

    @staticmethod
    def load(path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        scores = np.array([sp.get_score(i) for i in range(n)])
        own = scores[normal]
        if (own == np.round(own)).all():  # merge ranks
            ranks = np.empty(len(normal))
            ranks[np.lexsort((normal, -own))] = np.arange(len(normal))
            scores[normal] = -np.log(ranks + 1) - np.log((1 / np.arange(1, len(normal) + 1)).sum())
        keys = {sp.id_to_piece(i).encode(): i for i in normal}
        if any(MARK in p.decode().lstrip(MARK) for p in keys):
            raise ValueError("a piece has the marker after another character; words can't be solved apart")
        byte_ids = np.full(256, sp.unk_id(), np.int32)
        surface = [sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        for i in range(n):
            if sp.is_byte(i):
                byte = int(sp.id_to_piece(i)[3:5], 16)
                byte_ids[byte], surface[i] = i, bytes([byte])
            elif sp.is_control(i) or sp.is_unused(i):
                surface[i] = b""
        return Vocabulary(Trie.of(keys), scores, float(scores[normal].min()) - UNKNOWN_PENALTY, surface, byte_ids)


def char_bytes(lead: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 character that starts with this byte."""
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.cache: dict[str, bytes] = {}
        self.lists = None

    def _together(self, words: list[bytes]) -> list[bytes]:
        """Viterbi of short words at once: position by position, all of them walk the trie a byte at a time."""
        v, trie = self.v, self.v.trie
        size = np.array([len(w) for w in words])
        longest = int(size.max())
        text = np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8).reshape(len(words), longest).astype(np.int32)
        starts = (text & 0xC0) != 0x80
        best = np.full((len(words), longest + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros(best.shape, np.int16), np.full(best.shape, -1, np.int32)
        for s in range(longest):
            rows = np.flatnonzero((size > s) & starts[:, s])
            if not len(rows):
                continue
            width = char_bytes(text[:, s])
            single = np.zeros(len(words), bool)
            r, state = rows, np.zeros(len(rows), np.int32)
            for d in range(s, longest):
                to = trie.base[state] + text[r, d] + 1
                ok = (trie.check[to] == state) & (size[r] > d)
                r, state = r[ok], to[ok]
                if not len(r):
                    break
                found = trie.value[state]
                hit = found >= 0
                rr, ids = r[hit], found[hit]
                single[rr[width[rr] == d + 1 - s]] = True
                value = best[rr, s] + v.scores[ids]
                better = value > best[rr, d + 1]
                rr, ids = rr[better], ids[better]
                best[rr, d + 1], back[rr, d + 1], piece[rr, d + 1] = value[better], s, ids
            rows = rows[~single[rows]]
            if len(rows):
                e = s + width[rows]
                value = best[rows, s] + v.unknown
                better = value > best[rows, e]
                rows, e = rows[better], e[better]
                best[rows, e], back[rows, e], piece[rows, e] = value[better], s, -1
        at, every, steps, froms = size.copy(), np.arange(len(words)), [], []
        while (at > 0).any():
            steps.append(np.where(at > 0, piece[every, at], -2))
            froms.append(at)
            at = np.where(at > 0, back[every, at], 0)
        ids = np.stack(steps[::-1], 1)
        out: list[bytes] = [b""] * len(words)
        odd = (ids == -1).any(1)
        flat, ends = ids[ids != -2].astype("<i4").tobytes(), 4 * np.cumsum((ids != -2).sum(1))
        for i, (a, b, strange) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), odd.tolist())):
            out[i] = flat[a:b] if not strange else self._with_bytes(words[i], [(int(back[i, f[i]]), int(f[i]), int(p[i])) for p, f in zip(steps[::-1], froms[::-1]) if p[i] != -2])
        return out

    def _with_bytes(self, word: bytes, path: list[tuple[int, int, int]]) -> bytes:
        ids: list[int] = []
        for a, b, p in path:
            ids += [p] if p >= 0 else self.v.byte_ids[list(word[a:b])].tolist()
        return np.array(ids, "<i4").tobytes()

    def _alone(self, word: bytes) -> bytes:
        """Viterbi of one long word, in memory proportional to it."""
        if self.lists is None:
            t = self.v.trie
            self.lists = t.base.tolist(), t.check.tolist(), t.value.tolist(), self.v.scores.tolist()
        base, check, value, scores = self.lists
        n = len(word)
        best, back, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            if word[s] & 0xC0 == 0x80:
                continue
            width = int(char_bytes(np.array(word[s])))
            state, single, here = 0, False, best[s]
            for d in range(s, n):
                to = base[state] + word[d] + 1
                if check[to] != state:
                    break
                state = to
                p = value[state]
                if p >= 0:
                    single |= d + 1 - s == width
                    if here + scores[p] > best[d + 1]:
                        best[d + 1], back[d + 1], piece[d + 1] = here + scores[p], s, p
            if not single and here + self.v.unknown > best[s + width]:
                best[s + width], back[s + width], piece[s + width] = here + self.v.unknown, s, -1
        path, at = [], n
        while at:
            path.append((back[at], at, piece[at]))
            at = back[at]
        return self._with_bytes(word, path[::-1])

    @staticmethod
    def words(text: str) -> list[str]:
        """Marked words: a run of spaces (as itself here) and what follows up to the next space."""
        if not text:
            return []
        parts = text.split(" ")
        if "" not in parts:
            return [" " + p for p in parts]
        words, run = [], " "
        for p in parts[:-1]:
            if p:
                words.append(run + p)
                run = " "
            else:
                run += " "
        return [*words, run + parts[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of int32."""
        split = [self.words(t) for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = list(set().union(*split) - self.cache.keys())
        marked = [w.replace(" ", MARK).encode() for w in new]
        for word, data in zip(new, marked):
            if len(data) > LONG:
                self.cache[word] = self._alone(data)
        short = sorted((i for i in range(len(new)) if len(marked[i]) <= LONG), key=lambda i: len(marked[i]))
        for k in range(0, len(short), 8192):
            part = short[k : k + 8192]
            self.cache.update(zip([new[i] for i in part], self._together([marked[i] for i in part])))
        get = self.cache.__getitem__
        return [b"".join(map(get, w)) for w in split]

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.v.surface.__getitem__, np.frombuffer(ids, "<i4").tolist()))
        return data.removeprefix(b" ").decode("utf-8", "replace")


def _codec(shared) -> Codec:
    import sys

    kept = sys.modules.setdefault("_piece_codecs", type(sys)("_piece_codecs")).__dict__  # lives as long as the worker
    key = f"codec-{shared.id if hasattr(shared, 'id') else id(shared)}"
    return kept.get(key) or kept.setdefault(key, Codec(shared.value))


def encoded(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and the ids of the whole text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path or public_tokenizers.path("piece_bpe_32k.model")))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            ids = [np.frombuffer(x, "<i4") for x in codec.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, schema.field(1).type)], schema=schema)

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(encodings: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and the text of the ids; null ids count as none."""
    small_batches(encodings.sparkSession)
    shared = encodings.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path or public_tokenizers.path("piece_bpe_32k.model")))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            out = [codec.decode(np.array(x or [], "<i4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], schema=schema)

    return encodings.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Encode each whole text and decode it again: doc_id, n_chars, n_ids, n_byte_ids, ids_crc32 (of the int32, little
    endian), decoded_crc32 (of the UTF-8) and round_trip."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path or public_tokenizers.path("piece_bpe_32k.model")))
    names = ("doc_id", "n_chars", "n_ids", "n_byte_ids", "ids_crc32", "decoded_crc32")
    schema = pa.schema([(n, pa.int64()) for n in names] + [("round_trip", pa.bool_())])

    def run(batches):
        codec = _codec(shared)
        is_byte = np.zeros(len(codec.v.surface), bool)
        is_byte[codec.v.byte_ids] = True
        for batch in batches:
            plain = batch.column(1).to_pylist()
            rows = []
            for doc_id, text, ids in zip(batch.column(0).to_pylist(), plain, codec.encode(plain)):
                back = codec.decode(ids)
                rows.append((doc_id, len(text), len(ids) // 4, int(is_byte[np.frombuffer(ids, "<i4")].sum()), zlib.crc32(ids), zlib.crc32(back.encode()), back == text))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return texts(docs).mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", round_trip boolean")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"))
