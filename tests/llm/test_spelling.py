"""Groups of spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressmill.llm import spelling


def planted(rows, letters, planted):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % planted == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= letters:
                total[word] += 1
    return total


def near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(x) + 1 == len(y) and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(rows, letters=5, times=3, ratio=2, plant=97):
    n = {w: k for w, k in planted(rows, letters, plant).items() if k >= times}
    around = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, found in around.items():
        if found:
            best = min(found, key=lambda v: (-n[v], v))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(around[w]), n.get(form.get(w))))
    return sorted(out)


def found(spark, rows, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.variants(docs, **kwargs).collect())


def sample(seed, alphabet, vocabulary=120, docs=150):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(4, 9))) for _ in range(vocabulary)]
    words = list(base)
    for w in base:
        for _ in range(3):
            at = rng.randrange(len(w))
            words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(alphabet) + w[at:], w[:at] + rng.choice(alphabet) + w[at + 1 :]]))
    weight = [1 / (k + 1) for k in range(len(words))]
    rng.shuffle(weight)
    return [(i, rng.choice([" ", ", ", "1", "\n"]).join(rng.choices(words, weight, k=rng.randint(0, 80)))) for i in range(docs)]


@pytest.mark.parametrize("seed, alphabet, shard", [(1, "abcdefghijklmnopqrstuvwxyzáñ", 50_000), (2, "abé", 40), (3, "ABCabc÷×ÿ", 5), (4, "eaionsrt", 1)])
def test_against_brute_force(spark, seed, alphabet, shard):
    rows = sample(seed, alphabet)
    want = brute(rows)
    assert found(spark, rows, shard=shard) == want
    assert sum(r[4] for r in want) > 50 and any(r[1] for r in want)


def test_more_planted_misspellings(spark):
    rows = sample(5, "abcdefghij", 30)
    assert found(spark, rows, planted=3, times=2, letters=4) == brute(rows, 4, 2, 2, 3)


def test_odd_rows(spark):
    long = "q" * 3000
    rows = [(1, None), (2, ""), (None, "words words words wordz wordz wordz"), (3, "123 !!"), (4, f"{long} {long}x {long} {long}x {long} {long}x {long}"), (5, "abcde " * 9), (5, "abcde " * 9), (6, "abcdf " * 3), (7, "vwxyz " * 4 + "vwxya " * 8 + "vwxyb " * 8)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert {r[0]: r[1] for r in got}["vwxyz"] == "vwxya"  # of equal counts the least


def test_chains_are_followed_to_the_end(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc", "bbbcc", "bbccc"]
    rows = [(k, " ".join([w] * 3 * 2**k)) for k, w in enumerate(chain)]
    got = found(spark, rows, planted=10**9)
    assert got == brute(rows, plant=10**9)
    assert {r[2] for r in got} == {"bbccc"}


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == []
    docs = spark.createDataFrame([(1, "spell spell spell")], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "shard", "root")})
    assert [tuple(r) for r in spelling.variants(docs, planted=10**9).collect()] == [("spell", None, "spell", 3, 0, None)]


def test_one_edit():
    assert spelling.one_edit(b"abc", b"abd") and spelling.one_edit(b"abc", b"abcd") and spelling.one_edit(b"abc", b"xabc")
    assert not spelling.one_edit(b"abc", b"abc") and not spelling.one_edit(b"abc", b"acb") and not spelling.one_edit(b"abc", b"axbxc")
