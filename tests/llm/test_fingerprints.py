"""I-Match fingerprints against plain Python."""

import hashlib
import random
import re
import struct
import string

import xxhash
from pyspark.sql import functions as F

from pressmill.llm import imatch

SPLIT = re.compile("[" + re.escape(string.punctuation) + r" \t\n\x0b\f\r]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_text(word):
    return signed(xxhash.xxh64(word.encode(), seed=42).intdigest())


def of_longs(values):
    h = 42
    for v in values:
        h = xxhash.xxh64(struct.pack("<q", v), seed=h).intdigest()
    return signed(h)


def terms(text):
    return {of_text(w) for w in SPLIT.split(text.lower()) if w}


def hashes(found):
    thin = lambda values, shift, bits: [x for x in values if not ((x & (1 << 64) - 1) >> shift) & ((1 << bits) - 1)]
    found = sorted(found)
    again = [of_longs([x]) for x in found]
    sets = [found, *(thin(found, 60 + g, 1) for g in range(4)), *(thin(again, 60 + g, 2) for g in (0, 2))]
    drawn = [thin(v, 10 * g, imatch.RATES[0]) for v in (found, again) for g in range(6)]
    sets += drawn
    for bits in imatch.RATES[1:]:
        drawn = [thin(v, i % 6 * 10, bits) for i, v in enumerate(drawn)]
        sets += drawn
    return [of_longs(v) % 16777215 + 1 if v else 0 for v in sets]


def like(a, b, equal):
    same = [x == y for x, y in zip(a, b) if x or y]
    return sum(same) / len(same) if same else float(equal)


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    n, df = len(rows), {}
    for _, t in rows:
        for x in terms(t):
            df[x] = df.get(x, 0) + 1
    known = {x for x, k in df.items() if max(2.0, imatch.LEAST_SHARE * n) <= k <= max(2.0, imatch.MOST_SHARE * n)}

    def made(text):
        inside, outside = terms(text) & known, terms(text) - known
        return hashes(inside | set(sorted(outside, key=lambda x: (of_longs([x]), x))[: max(0, imatch.FEW_TERMS - len(inside))]))

    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % n][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        own, other = made(t), made(edited)
        name = lambda h: "".join(f"{x:06x}" for x in h)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), name(own), name(other), round(like(own, other, t == edited), 9), round(like(own, made(after), t == after), 9)))
    return sorted(out, key=str)


NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("side", "term", "known", "pos")})
    return sorted((tuple(round(r[c], 9) if "near" in c else r[c] for c in NAMES) for r in imatch.neighbour_fingerprints(docs).collect()), key=str)


def sample(seed, n, least=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeñü象") for _ in range(rng.randint(1, 5))) for _ in range(400)]
    return [(3 * i, rng.choice([" ", ", ", "\n", "  --"]).join(rng.choice(words).title() for _ in range(rng.choice([least, 3, 14, 17, 40, 300])))) for i in range(n)]


def test_against_plain_python(spark):
    rows = sample(1, 60) + [(1000, None), (1001, ""), (1002, "...!"), (1003, "same text here"), (1004, "same text here"), (1005, "Only Here"), (1006, "very long " * 40_000)]
    assert found(spark, rows) == brute(rows)


def test_small_tables(spark):
    for rows in ([], [(1, "alone in here")], [(None, "a b c"), (5, "a b d")]):
        assert found(spark, rows) == brute(rows)


def test_a_text_at_the_line_is_filled_up_by_one_term(spark):
    """15 and 16 terms of the lexicon: the fingerprints are of 16 terms each, 15 of them the same, however many others the texts have."""
    known = [f"w{k}" for k in range(16)]
    rare = [f"rare{k}" for k in range(200)]
    rows = [(0, " ".join(known[:15] + rare)), (1, " ".join(known + rare[:3]))] + [(2 + k, " ".join(known)) for k in range(2)] + [(10 + k, f"other{k}") for k in range(20)]
    got = found(spark, rows)
    assert got == brute(rows)


def test_without_a_lexicon_all_terms_are_kept(spark):
    """No term is in two documents: the fingerprint is that of all terms, and half a text left unchanged shows in it."""
    rows = [(k, " ".join(f"j{k}x{i}" for i in range(40))) for k in range(4)] + [(8, "solo"), (9, "")]
    got = {r[0]: r for r in found(spark, rows)}
    assert all(got[i][3] == "".join(f"{x:06x}" for x in hashes(terms(t))) for i, t in rows)
    assert all(got[k][5] > got[k][6] == 0 for k in range(4))
