"""Every archive query that SQL can express gives the rows that DuckDB gives."""

import datetime
import os

import duckdb
import pytest

from pressmill.plans import registry

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the stored tables aren't here")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted("|".join(plain(r[c]) for c in columns) for r in df.collect())
    found = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = sorted("|".join(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["html_issues", "html_next_pages"])
def test_pages_of_many_digits(spark, tmp_path, name):
    """Ids of five digits and more are the numbers of issues whole."""
    ids = [0, 7, 10, 999, 1000, 9999, 10000, 10001, 10002, 10003, 10004, 123456, 123458, 2000000001]
    rows = [(i, f"https://www.m.example/es/a/nota-{i}" + "?p=2#x" * (i % 2), "<h1>Nota</h1><p>x</p>") for i in ids]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    df = registry.queries()[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    found = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted("|".join(plain(r[c]) for c in columns) for r in df.collect()) == sorted("|".join(map(plain, r)) for r in found.fetchall())


def test_every_query_has_a_stable_schema(spark):
    for name in ("search_ranked", "pdf_split", "html_articles", "backtest", "lens_rising_top", "weak_signals"):
        first, second = (registry.queries()[name](spark, FOLDER) for _ in range(2))
        assert first.schema == second.schema and first.columns


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_lexemes_are_counted(spark):
    import re

    from pressmill.functions.stemmer import stem

    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 23 <> 0").select("text").collect()
    words = {w for r in rows for w in re.findall(r"\w+", (r["text"] or "").lower())}
    assert tuple(registry.queries()["lexemes"](spark, FOLDER).first()) == (len(set(map(stem, words))), len(words))
