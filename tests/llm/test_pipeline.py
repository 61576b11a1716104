"""The pipeline stage by stage against brute force on a small table, and its awkward rows."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from pressmill.llm import exact_dedup, near_dedup, packing, pii, quality
from pressmill.llm.common import staged


def tables(spark, folder):
    rng = random.Random(8)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(240):
        junk = i % 6 == 0
        text = " ".join(rng.choice(words) for _ in range(rng.choice((20, 90))))
        if junk:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif i % 10 == 1:
            text += f" correo a{i}@mail.example.com"
        docs.append((i, text, "es", "s", len(text)))
        labels.append((i, int(not junk), 0))
    good = [d for d in docs if d[0] % 6]
    docs += [(1000 + k, d[1], "es", "s", d[4]) for k, d in enumerate(good[:20])]
    docs += [(2000 + k, d[1] + " fin", "es", "s", d[4] + 4) for k, d in enumerate(x for x in good[20:60] if len(x[1].split()) >= 80)]
    docs += [(3000, None, "es", "s", 0), (3001, "", "es", "s", 0), (None, "sin número " * 30, "es", "s", 330), (5, docs[5][1], "es", "s", docs[5][4])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "minhash near-dedup", "private data", "best-fit packing"]
    kept = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, staged(stage(spark, docs, str(tmp_path)), "test")
        if k < 4:
            assert docs.columns == before.columns
        kept.append(docs.count())
        if k == 0:
            ids = {r[0] for r in docs.select("doc_id").collect()}
            assert not any(i in ids for i in range(0, 240, 6)) and all(i in ids for i in range(240) if i % 6)
        if k == 1:
            assert docs.select(F.coalesce("text", F.lit(""))).distinct().count() == docs.count()
        if k == 2:
            assert not [r for r in docs.collect() if (r["doc_id"] or 0) >= 2000 and r["doc_id"] < 3000]
        if k == 3:
            assert not [r for r in docs.collect() if "@mail.example.com" in (r["text"] or "")]
            assert all(r["n_chars"] == len(r["text"] or "") for r in docs.collect() if r["text"] is not None)
    assert kept[1] > kept[2] > kept[3] == kept[4]
    assert docs.select("doc_id").distinct().count() == kept[4]


def test_empty_table(spark, tmp_path):
    tables(spark, tmp_path)
    none = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0
        if "text" not in none.columns:
            break


def test_clashing_columns_and_a_very_long_text(spark, tmp_path):
    tables(spark, tmp_path / "plain")
    clash = ("score", "label", "kept", "keep_id", "class_id", "members", "surrogate", "_row", "_new", "piece", "length", "sequence_id", "offset", "uid", "salt", "key")
    docs = spark.read.parquet(f"{tmp_path}/plain/documents.parquet")
    long = spark.createDataFrame([(7777, "bosque lento " * 60_000 + "fin", "es", "s", 780_003)], docs.schema)
    docs.unionByName(long).withColumns({c: F.lit("x") for c in clash}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/plain/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    one = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = one.columns
        one = staged(stage(spark, one, str(tmp_path)), "test")
        assert one.columns == columns and all(r[c] == "x" for r in one.select(*clash).distinct().collect() for c in clash)
    want = {r["doc_id"] for r in one.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == want
    pieces = sorted((r["piece"], r["start"], r["length"]) for r in packed if r["doc_id"] == 7777)
    assert (not pieces and 7777 not in want) or all(a[1] + a[2] == b[1] for a, b in zip(pieces, pieces[1:]))


def test_stages_call_the_operators():
    assert {quality, exact_dedup, near_dedup, pii, packing} <= {v for v in vars(corpus_pipeline).values() if hasattr(v, "__file__")}


def test_growing_tables_are_not_broadcast(spark, tmp_path, monkeypatch):
    """An exploded array or a well compressed file looks small to Spark, whatever it holds; only ids to fetch, if few, may be sent round."""
    tables(spark, tmp_path)
    near = near_dedup.near_duplicates
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(map(str, near(docs).collect()))
    monkeypatch.setattr(near_dedup, "FETCHED", 0)
    states = spark._jsparkSession.sharedState().statusStore()
    before = states.executionsCount()
    assert sorted(map(str, near(docs).collect())) == want
    for stage in (corpus_pipeline.without_near_copies, corpus_pipeline.without_private_data, corpus_pipeline.packed):
        docs = staged(stage(spark, docs, str(tmp_path)), "test")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    done = states.executionsList()
    plans = [done.apply(k).physicalPlanDescription() for k in range(before, done.size())]
    assert any("SortMergeJoin" in p for p in plans) and not [p for p in plans if "BroadcastExchange" in p]
