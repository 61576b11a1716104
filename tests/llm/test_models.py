"""Classifiers by held-out accuracy, page extraction on made-up pages, all with awkward rows."""

import collections
import random
import zlib

import numpy as np
import pytest

from pressmill.llm import html_text, quality, subword, toxicity

DOCS = "doc_id long, text string, score double"


def corpus(seed, n=700):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        text, bad, toxic = [rng.choice(words) for _ in range(rng.choice((5, 60, 200)))], rng.random() < 0.3, rng.random() < 0.3
        if bad:
            text = [w.upper() + "!!" for w in text] if rng.random() < 0.5 else [w for w in text[:20] for _ in range(4)]
        if toxic:
            for k in rng.sample(range(len(text)), max(1, len(text) // 15)):
                text[k] = "zork" + rng.choice(("", "a", "en", "ig", "x" + str(i)))  # endings never seen before
        docs.append((i, " ".join(text), 0.5))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


@pytest.mark.parametrize("seed", [1])
def test_held_out_rows(spark, seed):
    docs, labels = corpus(seed)
    extra = [(None, "nada", 0.1), (9001, None, 0.1), (9002, "", 0.1), (9003, "palabra " * 120_000, 0.1), (9003, "palabra " * 120_000, 0.1)]
    d = spark.createDataFrame(docs + extra, DOCS)
    l = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    truth = {i: (q, t) for i, q, t in labels}
    for run, at, least in ((quality.quality_scores, 0, 0.9), (toxicity.toxicity_scores, 1, 0.9)):
        rows = run(d, l).collect()
        assert len(rows) == len(docs) + len(extra) and all(0 <= r["score"] <= 1 for r in rows)
        held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
        assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held) and len(held) > 80
        assert np.mean([(r["score"] >= 0.5) == bool(truth[r["doc_id"]][at]) for r in held]) >= least


def test_no_labels_or_no_rows(spark):
    d, none = spark.createDataFrame([(1, "a", 0.0)], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality.quality_scores(d, none).collect()] == [0.5]
    assert quality.quality_scores(d.limit(0), none).count() == 0
    kept = quality.keep_good(d, none)
    assert kept.columns == d.columns and kept.count() == 1


MASK = (1 << 64) - 1


def plain_features(text, settings):
    """Buckets of a text, one after another, in plain Python."""
    data = b" " + bytes(32 if c in b"\t\n\v\f\r" else c + 32 if settings.lowercase and 65 <= c <= 90 else c for c in text) + b" "
    shift, found = 64 - settings.bits, []
    for n in subword.GRAMS:
        for i in range(len(data) - n + 1):
            if 32 not in data[i + 1 : i + n - 1]:
                h = 0
                for c in data[i : i + n]:
                    h = (h * subword.PRIME + c + 1) & MASK
                h ^= h >> 29
                found.append(((h * (0xBF58476D1CE4E5B9 + 2 * n)) & MASK) >> shift)
    before = None
    for word in data.split():
        h = sum((c + 1) * pow(subword.PRIME, k, 1 << 64) for k, c in enumerate(word)) & MASK
        h ^= h >> 31
        found.append(((h * 0x94D049BB133111EB) & MASK) >> shift)
        if before is not None:
            found.append(int(h == before))
        before = h
    return collections.Counter(found)


@pytest.mark.parametrize("limit", [1 << 19, 64, 7, 1])
def test_features_of_texts_in_pieces(limit):
    texts = [("uno dos dos tres " * 20).encode(), b"", b" \t", b"x", b"tres", ("\n".join(["AB", "ab", "a" * 90, "a" * 90])).encode(), b"  a  a ", b"a", "ñandú ñandú".encode()]
    for settings in (subword.Settings(), subword.Settings(lowercase=True, bits=12)):
        hasher = subword.Hasher(settings)
        found = [collections.Counter() for _ in texts]
        for owners, starts, fresh, data in subword.pieces(texts, limit):
            for at, bucket in hasher(data, fresh):
                place = np.searchsorted(starts, at, "right") - 1
                for p, k in zip(place.tolist(), bucket.tolist()):
                    found[owners[p]][k] += 1
        assert found == [plain_features(t, settings) for t in texts]


@pytest.mark.parametrize("settings", [quality.SETTINGS, toxicity.SETTINGS])
def test_scores_by_hand(spark, settings):
    rng = np.random.default_rng(3)
    model = subword.Model(settings, rng.normal(0, 1, 1 << settings.bits).astype(np.float32), -0.3)
    texts = ["Uno dos  dos", "", None, "x", "GRITO grito\tgrito", "a" * 700, "ñ 象 😀"] * 3
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    for r in subword.score(d, model).collect():
        features = plain_features((texts[r["doc_id"]] or "").encode(), settings)
        mean = sum(float(model.weights[k]) * n for k, n in features.items()) / max(1, sum(features.values()))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-(mean + model.bias))), rel=1e-9)


def test_training_takes_gradients_of_its_loss():
    """On texts of one feature each the trained weights order the features as their shares of label 1 do."""
    s = subword.Settings(bits=6, epochs=20)
    rng = np.random.default_rng(5)
    share = {5: 0.02, 9: 0.3, 17: 0.7, 33: 0.98}
    feature = rng.choice(list(share), 1200)
    labels = (rng.random(1200) < np.array([share[f] for f in feature])).astype(np.int64)
    model = subword.fit(labels, [np.array([f], np.int32) for f in feature], [np.array([1], np.uint32)] * 1200, int(labels.sum()), int((labels == 0).sum()), s)
    got = [1 / (1 + np.exp(-(model.weights[f] + model.bias))) for f in share]
    assert got == sorted(got) and all(abs(g - p) < 0.12 for g, p in zip(got, share.values()))


@pytest.fixture(scope="module")
def model():
    return html_text.trained(pages=300, trees=40)


def test_made_up_pages(model):
    rng = random.Random(77)
    made = [html_text.sample_page(rng) for _ in range(120)]
    out = html_text.extract([p.replace("\x01", "") for p, _ in made], model)
    hit = got = want = 0
    for (_, blocks), text in zip(made, out):
        a, b = collections.Counter(" ".join(blocks).split()), collections.Counter(text.split())
        hit, got, want = hit + sum((a & b).values()), got + sum(b.values()), want + sum(a.values())
    assert hit / got > 0.97 and hit / want > 0.97


def test_no_kept_text_below_a_dropped_element(model):
    parent = [-1, 0, 1, 1, 0]
    kept = html_text.decode(parent, np.array([-9.0, -2.0, 1.0, 0.5, 0.1]))
    assert kept == [True, False, False, False, True]
    assert html_text.decode(parent, np.array([0.0, -1.0, 1.0, 0.5, -0.1])) == [True, True, True, True, False]


def test_decoding_against_all_closed_sets():
    """Of all choices in which a kept element's parent is kept, decoding gives one with the greatest sum of log odds."""
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(2, 9)
        parent = [-1] + [rng.randrange(k) for k in range(1, n)]
        odds = np.array([round(rng.uniform(-3, 3), 3) for _ in range(n)])
        best = max(sum(odds[v] for v in range(1, n) if mask >> v & 1) for mask in range(1, 1 << n, 2) if all(not mask >> v & 1 or mask >> parent[v] & 1 for v in range(1, n)))
        kept = html_text.decode(parent, odds)
        assert all(kept[parent[v]] or parent[v] == 0 for v in range(1, n) if kept[v])
        assert sum(odds[v] for v in range(1, n) if kept[v]) == pytest.approx(best)


PROSE = ["El ministro presentó ayer las cuentas del año, que muestran un déficit menor de lo previsto, según fuentes de la casa.", "La oposición pidió explicaciones en el pleno y recordó que las cifras no incluyen el gasto de las provincias.", "Los analistas esperan que la reforma se apruebe antes del verano, aunque el calendario sigue abierto."]


@pytest.mark.parametrize(
    "page",
    [
        "<div id=wrap><div id=top><a href=/>Inicio</a> | <a href=/p>Política</a> | <a href=/e>Economía</a></div><table><tr><td><ul><li><a href=1>Uno</a></li><li><a href=2>Dos</a></li></ul></td><td><div class=entry>{}</div></td></tr></table><div class=copyright>© 2020 Todos los derechos</div></div>",
        "<header><nav><a href=/>Inicio</a><a href=/x>Mundo</a></nav></header><main><section class=body>{}</section><section class=comments><h3>Comentarios</h3><p>Pepe: ¡qué razón!</p><p>Luis: no estoy de acuerdo</p></section></main><footer><p>Aviso legal</p></footer>",
        "<div class=cookie-banner>Usamos cookies. <button>Aceptar</button></div><div class=container><div class=col-8><article class=post>{}</article></div><div class=col-4><div class=widget><h4>Lo más leído</h4><ul><li><a href=a>Otra nota</a></li><li><a href=b>Y otra</a></li></ul></div></div></div>",
    ],
)
def test_layouts_written_by_hand(page):
    """Pages that no generator made: the article's paragraphs come out whole, menus and comments don't."""
    text = html_text.extract([page.format("".join(f"<p>{p}</p>" for p in PROSE))], html_text.trained())[0]
    assert [p for p in PROSE if p in text.split("\n")] == PROSE
    for left in ("Inicio", "Pepe", "cookies", "Lo más leído", "Aviso legal", "derechos"):
        assert left not in text, left


@pytest.mark.parametrize(
    "page,want",
    [
        ("<div>a<svg viewBox='0 0 1 1'/>b<p>c</p><svg><title>no</title><path d=x /></svg>d</div>", "ab c d"),
        ("<div><button>no</div><p>a</p><select><option>no<p>b</p><canvas>no<p>c</p>", "a b c"),
        ("<div><template><p>no</p></template>a<object><p>no</p></object><button><div>no</div></button>b</div>", "ab"),
        ("<button>no<p>a</p><button>no</button><p>b</p>", "a b"),
        ("<head><title>no</title><script>'</head>'</script></head><body><p>a</p>", "a"),
        ("<p class='overflow-hidden'>a</p><p class=hidden-print>b</p><p data-hidden=false>c</p><p aria-hidden='false'>d</p>", "a b c d"),
        ("<p hidden>no</p><p aria-hidden=true>no</p><p style='color:red; display: none'>no</p><p>a</p>", "a"),
    ],
)
def test_only_what_is_hidden_or_a_control_is_dropped(page, want):
    tree = html_text.parse(page)
    assert html_text.written(tree, [True] * len(tree.parent)).split() == want.split()


def test_page_text(spark, model):
    story = "".join(f"<p>Una frase &amp; otra\n   <b>más</b> larga, con datos&nbsp;de todo tipo, número {k}.</p>" for k in range(6))
    page = f"<html><head><title>t</title><script>x='<p>no</p>'</script></head><body><nav><ul><li><a href=/a>Inicio</a></li><li><a href=/b>Mundo</a></li></ul></nav><article><h1>El titular</h1>{story}<p><b>Sin cerrar<p>Última.</article><div class='comments'><div class=comment><p>¡Qué bien, gracias!</p></div></div><footer>&copy; Nadie</footer>"
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "texto plano, sin marcas.", "x"), (4, "u", "<p" * 4000 + "<div class='" * 50, "x"), (1, "u", page, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.main_text(df, model=model).collect()
    want = "El titular\n" + "\n".join(f"Una frase & otra más larga, con datos de todo tipo, número {k}." for k in range(6)) + "\nSin cerrar\nÚltima."
    assert [r["text"] for r in out if r["page_id"] == 1] == [want, want]
    assert {r["page_id"]: r["n_chars"] for r in out if r["page_id"] in (2, 3)} == {2: 0, 3: 0} and len(out) == 6
    assert [r["text"] for r in out if r["page_id"] is None] == ["texto plano, sin marcas."]
    assert html_text.main_text(df.limit(0), model=model).count() == 0
