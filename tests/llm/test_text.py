"""Fingerprints, surrogates, packing and pieces on small tables, against rules written out by hand."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from pressmill.llm import imatch, packing, pieces, pii

SCHEMA = "doc_id long, text string, score int, seed string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s") for i, t in rows], SCHEMA)


def sample(n=60, seed=3):
    rng = random.Random(seed)
    words = [f"palabra{k}" for k in range(300)]
    return [(10 * i, " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 3, 80, 300))))) for i in range(n)]


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 7)
    rows = sample() + [(5, None), (6, ""), (7, "uno dos tres"), (8, "uno dos tres")]
    out = {r["doc_id"]: r for r in imatch.neighbour_fingerprints(frame(spark, rows).repartition(5)).collect()}
    order = sorted(rows)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = out[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert out[7]["fingerprint"] == out[8]["fingerprint"] and out[7]["near_next"] == 1.0 and out[5]["near_next"] == 1.0
    big = [r for r in out.values() if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] for r in big]) > np.mean([r["near_next"] for r in big]) + 0.03
    assert imatch.neighbour_fingerprints(frame(spark, rows).limit(0)).count() == 0
    same = imatch.neighbour_fingerprints(frame(spark, [(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert sorted(r["n_chars"] for r in same) == [1, 3, 3]


def test_fingerprints_of_texts_outside_the_lexicon(spark):
    junk = [(k, " ".join(f"j{k}x{i}" for i in range(40))) for k in range(4)]
    out = imatch.neighbour_fingerprints(frame(spark, [*junk, (8, "solo"), (9, "")])).orderBy("doc_id").collect()
    zero = {r["doc_id"] for r in out if not r["fingerprint"].strip("0")}
    assert zero == {9} and len({r["fingerprint"] for r in out}) == 6
    assert all(r["near_edited"] > r["near_next"] == 0 for r in out[:4])


def test_surrogates(spark):
    rows = [
        (1, "Escriba a Ana.Paz@Mail.example.com, o a ana.paz@mail.example.com; tel. +1 (983) 555-7102."),
        (2, "ana.paz@mail.example.com y b@mail.example.com desde 152.143.123.131"),
        (3, "4539 5787 6362 1486, 4539578763621486, token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\""),
        (4, "Llamó la señora. Frau Müller y Herr Müller; Mrs. Ana Smith"),
        (5, "+1 983 555 7102 y +1!! (983)!! 555-7102"),
        (6, None), (7, ""), (8, "nada que ver, 2019 y 3,5"), (8, "nada que ver, 2019 y 3,5"), (None, "x@y.org"), (10, "password=e9b9ed9cc9 y PASSWORD=E9B9ED9CC9!! Api-Key: \"Zx81_kq\" secret: nada"), (9, "ß" * 100_000 + " 1.2.3.4"),
    ]
    df = frame(spark, rows)
    out = pii.replace_private(df)
    assert out.columns == [*df.columns, "n_entities"] and out.count() == len(rows)
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    for old in ("paz@", "Paz@", "983", "152.143", "4539578763621486", "24be64439e3e", "Müller", "Smith", "x@y"):
        assert all(old not in t for t in text.values() if t), old
    emails = re.findall(r"[\w.]+@[\w.]+", text[1] + " " + text[2])
    assert len({e.lower().rstrip(".") for e in emails}) == 2 and len({e.split("@")[1].rstrip(".").lower() for e in emails}) == 1
    cards = re.findall(r"\d[\d ]{14,}\d", text[3])
    assert cards[0].replace(" ", "") == cards[1] and len(cards[0]) == 19
    digits = [int(c) for c in reversed(cards[1])]
    assert sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0
    assert re.search(r"token = \"[0-9a-f]{40}\"", text[3])
    frau, herr = re.search(r"Frau (\w+)", text[4])[1], re.search(r"Herr (\w+)", text[4])[1]
    assert frau == herr and re.search(r"Mrs\. \w+na \w+", text[4])
    assert re.sub(r"\D", "", text[5])[:11] == re.sub(r"\D", "", text[5])[11:] == re.sub(r"\D", "", text[1])
    assert text[6] is None and text[7] == "" and text[8] == "nada que ver, 2019 y 3,5" and len(text[9]) == 100_008
    low, high, own = re.fullmatch(r'password=([0-9a-f]{10}) y PASSWORD=([0-9A-F]{10})!! Api-Key: "(\S+)" secret: nada', text[10]).groups()
    assert low == high.lower() != "e9b9ed9cc9" and own != "Zx81_kq" and re.fullmatch(r"[A-Z][a-z]\d\d_[a-z]{2}", own)
    again = {r["doc_id"]: r["text"] for r in pii.replace_private(df.repartition(3)).collect()}
    assert again == text and {r["doc_id"]: r["text"] for r in pii.replace_private(df, key="other").collect()} != text
    assert pii.replace_private(df.limit(0)).count() == 0


def test_mentions_of_a_person_and_more_forms(spark):
    rows = [
        (1, "Mr. John Smith came. Later Smith left, and John Smith spoke; SMITH wrote to john.smith@x.org. Blacksmith."),
        (2, "Smith and John are no names where nobody says so."),
        (3, "Dr. Alan Turing; my name is Ada Lovelace, Lovelace said."),
        (4, "555 123 4567, (020) 7946 0958, 0171 234567, 030 1234567"),
        (5, "2001:db8::1 und 2001:DB8:0:0:0:0:0:1, 10:30:15"),
        (6, "1700000000000 und 9780306406157 bleiben, 4539578763621486 nicht"),
        (7, "γιώργος@ελλάδα.gr, 山田@例え.jp"),
    ]
    out = {r["doc_id"]: r for r in pii.replace_private(frame(spark, rows)).collect()}
    text = {k: r["text"] for k, r in out.items()}
    given, surname = re.match(r"Mr\. (\w+) (\w+) came", text[1]).groups()
    assert text[1].startswith(f"Mr. {given} {surname} came. Later {surname} left, and {given} {surname} spoke; {surname.upper()} wrote to ") and text[1].endswith(" Blacksmith.")
    assert not re.search("(?i)smith|john", text[1].replace("Blacksmith", "")) and text[2] == rows[1][1]
    assert not re.search("Alan|Turing|Ada|Lovelace", text[3]) and re.search(r"name is (\w+) (\w+), \2 said", text[3])
    assert re.sub(r"\d", "0", text[4]) == re.sub(r"\d", "0", rows[3][1]) and not any(n in text[4] for n in ("123 4567", "7946", "234567"))
    assert re.fullmatch(r"[0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f] und [0-9A-F]{4}:[0-9A-F]{3}(:[0-9A-F]){6}, 10:30:15", text[5]) and "db8" not in text[5].lower()
    assert "1700000000000" in text[6] and "9780306406157" in text[6] and "4539578763621486" not in text[6] and out[6]["n_entities"] == 1
    assert re.fullmatch(r"[α-ω]{7}@[α-ω]{6}\.gr, [\u4e00-\u9fff]{2}@\S{2,3}\.jp", text[7]) and "γιώργος" not in text[7]


def test_no_original_is_left_and_surrogates_are_distinct(spark):
    """Every planted entity of a small table against the text that comes out."""
    rng = random.Random(21)
    planted, rows = [], []
    for i in range(120):
        digits = "".join(rng.choice("123456789") for _ in range(16))
        kinds = [f"u{rng.randrange(10**6)}@host{i % 5}.example.com", f"{rng.randint(11, 250)}.{rng.randint(11, 250)}.{rng.randint(11, 250)}.{rng.randint(11, 250)}", f"+1 {digits[:3]} {digits[3:6]} {digits[6:10]}", f"{digits[:3]}-{digits[3:5]}-{digits[5:9]}", f"{digits[:4]} {digits[4:8]} {digits[8:12]} {digits[12:]}", "".join(rng.choice("0123456789abcdef") for _ in range(40))]
        kinds = [k for k in kinds if rng.random() < 0.7]
        planted += kinds
        rows.append((i, " algo ".join(["inicio", *kinds, "fin"])))
    text = {r["doc_id"]: r["text"] for r in pii.replace_private(frame(spark, rows)).collect()}
    whole = "\n".join(text.values())
    assert not [p for p in planted if p in whole]
    new = [part for i, _ in rows for part in text[i].split(" algo ")[1:-1]]
    assert len(new) == len(planted) and len(set(new)) == len(set(planted)) and not set(new) & set(planted)


def test_no_two_entities_share_a_surrogate(spark):
    rows = [(i, f"{chr(97 + i % 26)}{i % 10}@m{i % 3}.org") for i in range(260)]
    text = {r["doc_id"]: r["text"] for r in pii.replace_private(frame(spark, rows)).collect()}
    pairs = {(rows[i][1], text[i]) for i in range(260)}
    assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
    assert not {a for a, _ in pairs} & {b for _, b in pairs}


def test_full_shapes_get_wider_and_clashes_left_are_an_error(spark, monkeypatch):
    ips = [("ip", ".".join(f"{k:04d}")) for k in range(10_000) if "0" not in f"{k:04d}"]
    forms = [*ips, ("secret", "------"), ("secret", "________"), *[("secret", f"-----{c}") for c in "ghijklmnopqrstuvwxyz"]]
    out = pii.surrogates(spark.createDataFrame(forms, "kind string, form string"), "k").collect()
    assert {(r["kind"], r["form"]) for r in out} == set(forms)
    made = {(r["kind"], r["surrogate"]) for r in out}
    assert len(made) == len(out) == len(forms) and not made & set(forms)
    monkeypatch.setattr(pii, "ROUNDS", 2)
    with pytest.raises(ValueError, match="without a surrogate"):
        pii.surrogates(spark.createDataFrame([("phone", str(k)) for k in range(10)], "kind string, form string"), "k")


def test_packing(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sample() + [(1, None), (2, ""), (3, " "), (4, "a  b\n c\t"), (5, "x<|endoftext|> y"), (6, "palabra " * 3000), (6, "palabra " * 3000), (None, "ñandú"), (7, "y" * 50_000), (8, "it's 1 234 ")]
    out = packing.pack(frame(spark, rows).repartition(3), rounds=20).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        want = []
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        for piece, (a, b) in enumerate([(0, first), *((s, s + 1024) for s in range(first, len(ids), 1024))]):
            want.append((piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        got = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by[i])
        assert got == sorted(want * sum(j == i for j, _ in rows))
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= 1.03 * sum(r["length"] for r in out) / 1024 + 1
    assert packing.pack(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed,n", [(1, 50), (2, 20_000)])
def test_plan_places_each_length(seed, n):
    counts = np.bincount(np.random.default_rng(seed).integers(1, 256, n), minlength=257)
    placed, sequences = np.zeros(257, int), 0
    for config, times in packing.plan(counts, 256, rounds=60):
        assert times > 0 and sum(v * a for v, a in config.items()) <= 256
        sequences += times
        for v, a in config.items():
            placed[v] += a * times
    assert (placed == counts).all() and sequences <= 1.01 * (np.arange(257) * counts).sum() / 256 + 8


def test_pieces(spark):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = pieces.Vocabulary.load(path)
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1  # unigram, with the same scores
    for p, s in zip(proto.pieces, vocabulary.scores):
        p.score = float(s)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["", "a", " a", "a  b\n c ", "ﬁ Ⅷ\x00 x", "abc" * 300 + "日本語" * 40, "El rápido zorro marrón, ¿salta?", "  ", "x\n\n\ty"]
    codec = pieces.Codec(vocabulary)
    for t, data in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(data, "<i4").tolist()
        assert codec.decode(data) == t and library.decode(ids) == library.decode(library.encode(t))
        score = lambda x: sum(vocabulary.scores[i] for i in x)
        assert score(ids) == pytest.approx(score(library.encode(t)), abs=1e-3)
    rows = frame(spark, [*enumerate(texts), (50, None), (51, "▁"), (None, "z"), (0, "")])
    out = {r["doc_id"]: r for r in pieces.round_trips(rows).collect()}
    assert out[50]["n_ids"] == 0 and not out[51]["round_trip"] and all(out[i]["round_trip"] for i in range(len(texts)))
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(pieces.encoded(rows)).collect()}
    assert back[6] == texts[6] and pieces.round_trips(rows.limit(0)).count() == 0


def test_account_numbers_keep_valid_check_digits(spark):
    """Remainder 1 by 97 of the number with its first four characters at the end, letters as 10 to 35; also in groups."""
    known = ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NL91 ABNA 0417 1643 00", "ES9121000418450200051332", "FR1420041010050500013M02606", "DE89 3704 0044 0532 0130 00"]
    docs = spark.createDataFrame([(k, f"Konto {n}, danke.") for k, n in enumerate(known)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.replace_private(docs).collect()}
    for k, n in enumerate(known):
        new = got[k].removeprefix("Konto ").removesuffix(", danke.")
        plain = new.replace(" ", "")
        assert new != n and len(new) == len(n) and [c == " " for c in new] == [c == " " for c in n] and plain[:2] == n[:2]
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert got[1].split()[1].strip(",") == got[5].removeprefix("Konto ").removesuffix(", danke.").replace(" ", "")
