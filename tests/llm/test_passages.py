"""Removal of repeated passages against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pressmill.llm import passages

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept) by comparing each window with all that start earlier."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, int.from_bytes(hashlib.sha256((r[1] or "").encode()).digest()[:8], "big", signed=True)))
    seen, out = set(), []
    for doc_id, text in order:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone |= set(range(i, i + window))
            seen.add(w)
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def found(spark, rows, window, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = passages.remove_passages(docs, window=window, with_text=True, **kwargs).collect()
    for r in got:
        assert r["kept_sha256"] == hashlib.sha256(r["kept"].encode()).hexdigest()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str)


@pytest.mark.parametrize("window", [2, 3, 7, 20])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    phrase = [" ".join(rng.choice("ab cd efg h ñandú 象 x-1".split()) for _ in range(rng.randint(1, 60))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(phrase) if rng.random() < 0.5 else " ".join(str(rng.randint(0, 30)) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "\n", " \t ", "\x0b"]).join(parts)))
    assert found(spark, rows, window, chunk=700) == brute(rows, window)
    assert found(spark, rows, window) == brute(rows, window)


def test_odd_rows(spark):
    long = " ".join(str(i % 997) for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (1, "x a b c d"), (9, long), (8, "  a b 　"), (10, "a a a a a a a")]
    assert found(spark, rows, 3, chunk=100) == brute(rows, 3)


def test_empty_table_and_clashing_names(spark):
    assert found(spark, [], 20) == []
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c d")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("chunk", "bucket", "kept", "n_words", "answers")})
    got = {r["doc_id"]: r["n_removed"] for r in passages.remove_passages(docs, window=3).collect()}
    assert got == {1: 0, 2: 3}
    one = spark.createDataFrame([(1, "a b c a b c")], "doc_id long, text string")
    assert passages.remove_passages(one, window=3).first()["n_removed"] == 3


def test_a_passage_in_every_text_stays_once(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(i, f"{i} {passage} x{i}") for i in range(300)]
    got = found(spark, rows, 20, chunk=2000)
    assert [r[2] for r in sorted(got)] == [0] + [25] * 299
