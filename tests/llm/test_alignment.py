"""Alignment of two tokenizations against brute force over whole texts."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pressmill.llm import alignment

ZERO = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def models():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    a = Tokenizer.from_file(path)
    a.encode_special_tokens = True
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte = {chr(b): b for b in keep}
    for b in range(256):
        if b not in keep:
            byte[chr(256 + len(byte) - len(keep))] = b
    with open(path) as f:
        entries = {i: bytes(byte.get(c, 63) for c in e) for e, i in json.load(f)["model"]["vocab"].items()}
    return a, entries, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text, models):
    a, entries, b = models
    if not text:
        return None
    ours = [(i, entries[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    theirs = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        theirs.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    data = (" " + text).encode()
    return (ours, theirs) if b"".join(x for _, x in ours) == data and b"".join(x for _, x in theirs) == data else None


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(rows, models):
    links, made = [], []
    for _, text in rows:
        found = tokens(text, models)
        made.append(found and tuple(map(spans, found)))
        links.append([(i, j) for i, s, e in made[-1][0] for j, t, f in made[-1][1] if s < f and t < e] if found else [])
    count = {}
    for each in links:
        for pair in set(each):
            count[pair] = count.get(pair, 0) + 1
    most = {}
    for (i, _), n in count.items():
        most[i] = max(n, most.get(i, 0))
    out = []
    for (doc_id, _), pair, each in zip(rows, made, links):
        if not pair:
            out.append((doc_id, *ZERO))
            continue
        ours, theirs = pair
        cuts = sorted({e for _, _, e in ours} & {e for _, _, e in theirs})
        groups = [",".join(str(i) for i, _, e in ours if a < e <= b) + "|" + ",".join(str(i) for i, _, e in theirs if a < e <= b) for a, b in zip([0, *cuts], cuts)]
        out.append((doc_id, len(ours), len(theirs), len(groups), len(each), sum(count[p] == most[p[0]] for p in each), sum(count[p] for p in each), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(spark, rows, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r[c] for c in NAMES) for r in alignment.alignments(docs, **kwargs).collect()), key=str)


def sample(seed, n=60):
    rng = random.Random(seed)
    words = "the internationalisation naïve don't 12345 ñandú 象形文字 <|endoftext|> <s> </s> <0x0A> \U0001f600 x=y; Ünïcödé aaaaaaaaaaaa ... http://a.b/c?d=e".split()
    blanks = [" "] * 12 + ["  ", "\n", "\n\n", " \n ", "\t", " ", "　", "​", "\x1c", "\r\n", "\0"]
    return [(i, "".join(rng.choice(words) + rng.choice(blanks) for _ in range(rng.randint(0, 40)))) for i in range(n)]


def test_against_brute_force(spark, models):
    rows = sample(1) + [(100, None), (101, ""), (102, " "), (103, "  two spaces"), (104, "a ▁ b"), (None, "same text"), (105, "same text"), (105, "same text"), (106, "\n"), (107, "ends with space "), (108, "x" * 3000)]
    want = brute(rows, models)
    assert found(spark, rows) == want
    assert sum(r[1:] == ZERO for r in want) >= 3 and sum(r[3] for r in want) > 500


@pytest.mark.parametrize("pairs", [0, 1, 25])
def test_counts_that_are_joined_equal_those_broadcast(spark, models, pairs):
    rows = sample(2, 40)
    assert found(spark, rows, pairs=pairs) == brute(rows, models)


def test_gallop():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (sorted(rng.sample(range(1, 200), rng.randint(0, k))) for k in (20, 150))
        at = alignment.gallop(np.array(a, np.int64), np.array(b, np.int64), np.zeros(len(a), np.int64))
        assert at.tolist() == [b.index(x) if x in b else -1 for x in a]
        known = [rng.randint(0, max(0, sum(y < x for y in b))) for x in a]
        assert alignment.gallop(np.array(a, np.int64), np.array(b, np.int64), np.array(known, np.int64)).tolist() == at.tolist()


@pytest.mark.parametrize("unit, chunks, go, cells", [(1, 1, 1, 0), (300, 40, 50, 0), (5000, 3, 1 << 16, 1 << 25)])
def test_results_dont_depend_on_sizes(spark, models, monkeypatch, unit, chunks, go, cells):
    for name, value in (("UNIT", unit), ("CHUNKS", chunks), ("GO", go), ("CELLS", cells)):
        monkeypatch.setattr(alignment, name, value)
    rows = sample(7, 50)
    assert found(spark, rows) == brute(rows, models)


def test_chunks_join_to_the_text():
    for _, text in sample(4, 200):
        assert "".join(alignment.chunks_of(text)) == " " + text


def test_empty_table_clashing_names_and_groups(spark):
    assert found(spark, []) == []
    docs = spark.createDataFrame([(1, "plain words here")], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("uid", "pair", "n", "rare", "n_a", "groups")})
    row = alignment.alignments(docs, with_groups=True).first()
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] and row["n_groups"] == row["groups"].count(";") + 1
