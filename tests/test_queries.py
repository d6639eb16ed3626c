"""Every core query runs over the smallest tables and agrees with its SQL."""

import glob
import math
import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return [_value(x) for x in v] if isinstance(v, list | tuple) else v


def same(df, con, sql):
    cols = sorted(df.columns)
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    return sorted(repr([_value(x[c]) for c in cols]) for x in df.collect()) == sorted(repr([_value(x[i]) for i in at]) for x in r.fetchall())


def test_core_queries(spark):
    duckdb = pytest.importorskip("duckdb")
    from marginalia.plans.oracle import oracle_sql
    from marginalia.plans.queries import queries

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    sql, known = oracle_sql(), queries()
    assert set(sql) <= set(known)
    wrong = [n for n, f in known.items() if (not same(f(spark, DATA), con, sql[n]) if n in sql else f(spark, DATA).count() < 0)]
    assert wrong == []


def test_html_text_takes_every_source(spark, tmp_path):
    from marginalia.plans.queries import queries

    docs = [(1, "html-a", "<p>One &amp; two</p>"), (2, "pdf", "<b>bold</b> text"), (3, None, "a &lt; b"), (4, "pdf", None), (5, "txt", "plain  text")]
    spark.createDataFrame(docs, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in queries()["html_text"](spark, str(tmp_path)).collect()}
    assert got == {1: "One & two", 2: "bold text", 3: "a < b", 5: "plain text"}


def test_lookup_snapshots_hold_every_key(spark):
    from marginalia.functions.doi import norm_doi
    from marginalia.plans.queries import _rows, _sources

    arxiv, crossref, _ = _sources(spark, DATA)
    rows = _rows(spark, DATA)
    assert arxiv.count() == rows.where("arxiv <> ''").select("arxiv").distinct().count()
    assert crossref.count() == rows.select(norm_doi(rows["doi"]).alias("d")).where("d is not null").distinct().count()
    assert {r["status"] for r in arxiv.select("status").union(crossref.select("status")).distinct().collect()} == {"hit", "miss", "transient"}
