"""Exact, near and passage deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.llm import exact_dedup, near_dedup, repeats

SCHEMA = "doc_id long, text string"


def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "a\nb"), (None, "a b"), (6, "x" * 300_000), (7, "x" * 300_000), (7, "x" * 300_000), (8, "único")]
    return spark.createDataFrame([(i, t, "s", 1, "k", 2) for i, t in rows], SCHEMA + ", sha string, kept int, _kept_sha string, score int")


def exact_by_hand(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    return sorted((str(i), min((j for j, u in norm if u == t and j is not None), default=None), sum(u == t for _, u in norm), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm)


@pytest.mark.parametrize("budget", [exact_dedup.TABLE_BYTES, 200])
def test_exact(spark, budget):
    rng = random.Random(1)
    rows = [(i, rng.choice(["un texto", "un  texto", "otro", f"solo {i}", "largo " * 50 + str(i % 7)])) for i in range(300)]
    for df in (spark.createDataFrame(rows, SCHEMA).repartition(5), awkward(spark)):
        got = exact_dedup.exact_dedup(df, table_bytes=budget).collect()
        want = exact_by_hand([(r["doc_id"], r["text"]) for r in df.collect()])
        assert sorted((str(r["doc_id"]), r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
        assert sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_colliding_slots_compare_contents():
    table = exact_dedup.ContentTable(4)
    digest = b"\0" * 32
    for k in range(50):
        at, slot = table.find(digest, b"%d" % k)
        assert at < 0 and table.add(digest, b"%d" % k, slot) == k
    assert [table.find(digest, b"%d" % k)[0] for k in range(50)] == list(range(50))


def test_kept_rows(spark):
    for keep in (exact_dedup.keep_first, near_dedup.keep_one):
        df = awkward(spark)
        out = keep(df)
        assert out.columns == df.columns
        texts = [re.sub(r"\s+", " ", r["text"] or "").strip() for r in out.collect()]
        assert sorted(map(len, texts))[-1] == 300_000 and len([t for t in texts if t == "a b"]) == 1
        assert keep(df.limit(0)).count() == 0


def bags(texts):
    return [near_dedup.shingles(*near_dedup.Words()([t.encode().translate(near_dedup.FOLD)]))[1:] for t in texts]


def test_probability_jaccard_and_registers():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    pairs = []
    for _ in range(40):
        a = [rng.choice(words) for _ in range(150)]
        b = list(a)
        for k in rng.sample(range(150), rng.randint(0, 20)):
            b[k] = "new"
        pairs.append((" ".join(a), " ".join(b)))
    errors = []
    for a, b in pairs:
        (ha, ca), (hb, cb) = bags([a, b])
        x, y = dict(zip(ha.tolist(), ca / ca.sum())), dict(zip(hb.tolist(), cb / cb.sum()))
        want = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)
        assert near_dedup.probability_jaccard(ha, ca, hb, cb) == pytest.approx(want)
        w = [near_dedup.registers(np.zeros(len(h), int), h, c, 1)[0] for h, c in ((ha, ca), (hb, cb))]
        errors.append((w[0] == w[1]).mean() - want)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(9)
    words = [f"palabra{k}" for k in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice((6, 40, 120, 400)))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    # a chain: each text is like the next, the ends are not alike
    chain = [rng.choice(words) for _ in range(300)]
    for k in range(8):
        rows.append((len(rows), " ".join(chain[12 * k : 12 * k + 200])))
    rows += [(len(rows) + k, t) for k, t in enumerate(("", None, "  ", "one two", "ONE  two"))]
    b = bags([t or "" for _, t in rows])
    head = list(range(len(rows)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = not len(b[i][0]) and not len(b[j][0])
            if same or (len(b[i][0]) and len(b[j][0]) and near_dedup.probability_jaccard(*b[i], *b[j]) >= 0.8):
                x, y = sorted((find(i), find(j)))
                head[y] = x
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i in range(len(rows))}
    assert sum(r["kept"] for r in got) == len({find(i) for i in range(len(rows))})


def linked_by_hand(texts):
    """All pairs of similarity 0.8 or more, by comparing those that share a shingle."""
    b = bags(texts)
    return [(i, j) for i in range(len(b)) for j in range(i) if near_dedup.probability_jaccard(*b[i], *b[j]) >= 0.8]


def test_links_of_large_groups(spark):
    """Some hundred copies that differ from one text in a few words, of which only some pairs are alike, and some hundred
    texts that share half of their words: at least 0.9 of the links, here nearly all, end in one class, no other pair does."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    base, half = [rng.choice(words) for _ in range(200)], [rng.choice(words) for _ in range(100)]
    rows = []
    for _ in range(300):
        copy = list(base)
        for k in rng.sample(range(200), rng.choice((1, 2, 4))):
            copy[k] = rng.choice(words)
        rows.append(" ".join(copy))
    rows += [" ".join(half + [rng.choice(words) for _ in range(100)]) for _ in range(300)]
    links = linked_by_hand(rows)
    assert len(links) > 3000
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(rows)), SCHEMA).repartition(4)).collect()
    named = {r["doc_id"]: r["class_id"] for r in got}
    assert sum(named[i] == named[j] for i, j in links) >= 0.99 * len(links)
    assert all(r["class_size"] == 1 for r in got if r["doc_id"] >= 300)


def test_signatures_estimate_similarity():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(500)]
    base = [rng.choice(words) for _ in range(300)]
    for changed in (0, 6, 15, 40):
        copy = list(base)
        for k in rng.sample(range(300), changed):
            copy[k] = "new"
        two = bags([" ".join(base), " ".join(copy)])
        s = near_dedup.probability_jaccard(*two[0], *two[1])
        a, b = (near_dedup.signatures(near_dedup.registers(np.zeros(len(h), int), h, c, 1, near_dedup.BITS))[0] for h, c in two)
        differing = sum(int(x ^ y).bit_count() if x ^ y >= 0 else int((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a.tolist(), b.tolist()))
        assert abs(differing / near_dedup.BITS - (1 - s) / 2) < 0.06


def test_row_kept_of_equal_ones(spark):
    """Of rows that differ in other columns only the same one stays, however they are dealt out."""
    rows = [(5, "a  b", {"k": [1]}, "z"), (5, "a b", {"k": [2]}, "y"), (5, "a b", {"k": [1]}, "x"), (6, "a b", None, "a"), (None, None, None, None), (None, "", None, "b")]
    schema = "doc_id long, text string, more map<string,array<int>>, Row string"
    for keep in (exact_dedup.keep_first, near_dedup.keep_one):
        found = {tuple(map(str, sorted(map(str, keep(spark.createDataFrame(rows, schema).repartition(n)).collect())))) for n in (1, 3, 7)}
        assert len(found) == 1
    kept = exact_dedup.keep_first(spark.createDataFrame(rows, schema), table_bytes=1).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["Row"]) for r in kept) == [(0, "", None), (5, "a  b", "z")]


def removed_by_hand(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for (doc_id, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append((str(doc_id), len(d), sum(gone), sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("sub,shard", [(repeats.SUB, repeats.SHARD), (2, 500)])
def test_repeats_match_brute_force(spark, sub, shard):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [make(n) for n in (90, 130, 400)]
    rows = []
    for i in range(60):
        text = make(rng.choice((0, 20, 64, 200)))
        if rng.random() < 0.7:
            p = rng.choice(passages)
            cut = rng.randint(0, 30)
            text += p[cut:] + make(rng.randint(0, 50))
        rows.append((i, text))
    rows += [(100, "ab" * 200), (101, "ab" * 35 + "x"), (102, None), (103, ""), (104, rows[3][1]), (104, rows[3][1]), (None, passages[2])]
    got = repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), length=64, sub=sub, shard=shard).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == removed_by_hand(rows, 64)
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def same_as_by_hand(df, rows, **parameters):
    got = repeats.remove_repeats(df, length=64, **parameters).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == removed_by_hand(rows, 64)


def test_repeats_of_a_common_anchor(spark):
    """Thousands of different texts around one short passage, of which some share a little more and so repeat."""
    rng = random.Random(12)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, longer = make(60), make(30)
    rows = [(i, make(50) + passage + (longer[: rng.randint(0, 9)] if i % 9 == 0 else "") + make(50)) for i in range(5000)]
    same_as_by_hand(spark.createDataFrame(rows, SCHEMA).repartition(4), rows, sub=40)


def test_repeats_of_very_long_texts(spark, monkeypatch):
    """Texts longer than the positions of one segment, and a table with other columns of clashing names."""
    monkeypatch.setattr(repeats, "POSITION_BITS", 11)
    rng = random.Random(13)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = make(3000)
    rows = [(1, make(9000) + passage + make(5000)), (2, passage[700:] + make(4000) + passage[:900]), (3, make(2048)), (4, make(2047)), (None, None), (5, "")]
    same_as_by_hand(spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], SCHEMA + ", n_removed int, key string, anchor binary"), rows)


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for data in (b"banana", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", bytes(rng.choices(b"ab", k=700)) * 3, b"\0\0a\0\0a"):
        sa = repeats.suffix_array(data)
        assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        shared = repeats.common_prefixes(data, sa, 24)
        for k in range(1, len(data)):
            a, b = data[sa[k - 1] :], data[sa[k] :]
            true = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            if min(len(a), len(b)) >= 24:
                assert (shared[k] >= 24) == (true >= 24) and shared[k] <= true
