import io
import json
import urllib.error
import zipfile

import pytest
from pyspark.sql import functions as F

from marginalia.sinks import docs, reports, tables
from marginalia.sources import files, records, services
from marginalia.streaming import batches


def test_records(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text(json.dumps([{"ref": "A", "title": "Über", "year": 2000}, {"ref": "B", "extra": 1}], ensure_ascii=False), encoding="utf-8")
    got = records.json_array(spark, str(p), records.ROWS).orderBy("row_pos").collect()
    assert [(r["row_pos"], r["ref"], r["title"], r["year"]) for r in got] == [(0, "A", "Über", 2000), (1, "B", None, None)]
    df = records.from_stdin(spark, records.CITATIONS, io.StringIO('[{"label": "x", "expect_year": 2020}]'))
    assert df.head()["expect_year"] == "2020" and records.key_column(df) == "label"
    lines = tmp_path / "l.json"
    lines.write_text('{"slug": "a"}\nnot json\n')
    assert [r["slug"] for r in records.json_lines(spark, str(lines), records.PAPERS).collect() if r["_corrupt_record"] is None] == ["a"]


def test_fetch_retries():
    calls, waits = [], []

    def opener(req, timeout):
        calls.append(1)
        if len(calls) < 3:
            raise urllib.error.HTTPError("u", 503, "later", {}, None)
        return io.BytesIO(b"ok")

    assert services.fetch("http://x", "me", opener, wait=waits.append) == b"ok" and waits == [3, 6]

    def gone(req, timeout):
        raise urllib.error.HTTPError("u", 404, "no", {}, None)

    with pytest.raises(urllib.error.HTTPError):
        services.fetch("http://x", "me", gone, wait=waits.append)
    assert len(waits) == 2


def test_lookup_batches():
    r = services._Reader({"ids": json.dumps(["a", "b", "a", "c"]), "batch": "2", "url": "http://127.0.0.1:1/{ids}", "agent": "me"})
    assert [p.batches for p in r.partitions()] == [[["a", "b"]], [["c"]]]


def test_payloads(spark):
    msg = {"title": ["Sleep:"], "subtitle": ["a review"], "author": [{"family": "Tang", "given": "Jerry"}, {"given": "X"}, {"family": "Huth", "given": "A. G."}], "published-online": {"date-parts": [[2023]]}, "issued": {"date-parts": [[2022]]}, "institution": "bioRxiv", "volume": "26", "reference": [{"DOI": "10.1/X", "year": "2000"}]}
    df = spark.createDataFrame([("a", json.dumps(msg), "V (x)")], "slug string, j string, venue string").withColumn("message", F.from_json("j", services.MESSAGE))
    r = df.select(services.crossref_record(F.col("message"), F.col("venue")).alias("r")).head()["r"]
    assert (r["title"], r["year"], r["first_author"], r["people"], r["journal"], r["volume"]) == ("Sleep: A review", "2023", "Tang J", ["Tang, J.", "Huth, A. G."], "bioRxiv", "26")
    assert services.reference_edges(df).head()["doi"] == "10.1/x"
    feed = "<feed><entry><id>http://arxiv.org/abs/2305.18274v2</id><title>A\n  title</title><published>2023-05-01</published><author><name>Jerry Tang</name></author><arxiv:journal_ref>Nat 26</arxiv:journal_ref></entry><entry><id>x</id><title>Error</title></entry></feed>"
    e = services.arxiv_entries(spark.createDataFrame([(feed,)], "feed string")).collect()
    assert [(x["id"], x["title"], x["year"], x["first_author"], x["journal_ref"]) for x in e] == [("2305.18274", "A title", "2023", "Jerry Tang", "Nat 26")]


def test_guard(spark, tmp_path):
    p = str(tmp_path / "t")
    plain, canon = spark.createDataFrame([("a", None)], "ref string, canonical_at string"), spark.createDataFrame([("b", "2024")], "ref string, canonical_at string")
    tables.guarded_overwrite(plain, p)
    tables.guarded_overwrite(canon, p)
    with pytest.raises(tables.CanonicalTableError):
        tables.guarded_overwrite(plain, p)
    assert spark.read.parquet(p).head()["ref"] == "b"
    tables.guarded_overwrite(plain, p, force=True)
    assert spark.read.parquet(p).head()["ref"] == "a"
    with pytest.raises(ValueError):
        tables.bounded(spark.range(5), 4)


def test_reports(spark, tmp_path):
    cols = [*reports.COLUMNS, "family", "cite_openalex", "cite_s2", "source", "row_pos"]
    df = spark.createDataFrame([("A", "t", "x & y", "http://l", "s", "g", "", "", None, 0, None, "lab", 1)], ", ".join(f"{c} {'bigint' if c.startswith('cite') or c == 'row_pos' else 'string'}" for c in cols))
    assert reports.sheet_table(df).columns == ["ref", "topic", "apa", "link", "summary", "tag", "cite", "pdf", "xref", "_source"]
    assert reports.spreadsheet(df, str(tmp_path / "a.xlsx")) == 1
    with zipfile.ZipFile(tmp_path / "a.xlsx") as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    assert "x &amp; y" in sheet and "<v>0</v>" in sheet and 'state="frozen"' in sheet
    reports.document({"title": "T", "authors": ["A", "B"], "sections": [{"heading": "H", "paragraphs": ["p"]}]}, ["R."], str(tmp_path / "d.docx"))
    assert zipfile.ZipFile(tmp_path / "d.docx").testzip() is None
    cells = spark.createDataFrame([("f", "t", 2)], "family string, topic string, n bigint")
    codes, members = spark.createDataFrame([("t", "T")], "topic string, code string"), spark.createDataFrame([("f", "A", None, "a|b")], "family string, ref string, year int, apa string")
    md = reports.families_markdown(cells, codes, members)
    assert "| f | 2 | 2 |" in md and "a\\|b" in md
    svg = reports.figure(spark.createDataFrame([("f", 0.5, 0.0, "A", "L<1")], "family string, x double, offset double, ref string, label string"), ["f"])
    assert "L&lt;1" in svg and "</script>" not in reports.page(svg, [{"a": "</script>"}], "t").split('id="data">')[1].removesuffix("</script>")


def test_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    assert {r["path"].split("/")[-1]: r["is_pdf"] for r in files.recent_pdfs(spark, str(tmp_path), 1).collect()} == {"a.pdf": True, "b.pdf": False}


def test_streaming(spark, tmp_path):
    src = tmp_path / "in"
    for i, refs in enumerate([["a", "b", "b"], ["a", "c"]]):
        spark.createDataFrame([(r,) for r in refs], "ref string").coalesce(1).write.parquet(str(src / str(i)))
        q = batches.gated_append(spark.readStream.schema("ref string").option("recursiveFileLookup", "true").parquet(str(src)), str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r["ref"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "c"]
    assert sorted(r["ref"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["a", "b", "b"]
    ev = spark.sql("select timestamp'2024-01-01 10:00:00' ts, 'x' k union all select timestamp'2024-01-01 23:00:00', 'x'")
    assert batches.windowed_counts(ev, "ts", "k").head()["n"] == 2


def test_downloads(tmp_path):
    asked = []

    def get(url):
        asked.append(url)
        if "arxiv" in url:
            raise OSError
        return b"%PDF" + b"x" * 6000 if "open" in url else b"<html>"

    sources = files.candidates("2305.1", ["https://blocked.org/a", "https://html.org/a", "https://open.org/a"], "PMC1")
    assert files.download("s", sources, str(tmp_path), get, ("blocked.org",))[0] == "unpaywall" and len(asked) == 3
    assert files.download("s", sources, str(tmp_path), get)[0] == "exists" and files.download("t", [], str(tmp_path), get)[0] == "FAIL"
    moves = [(str(tmp_path / "s.pdf"), "slug")]
    assert files.rename(moves, str(tmp_path)) and (tmp_path / "s.pdf").exists() and files.rename(moves, str(tmp_path), dry=False) and (tmp_path / "slug.pdf").exists()


def test_docs(tmp_path):
    assert docs.purpose('"""One thing. Another."""') == "One thing." and docs.purpose("x = 1") == ""
    text = f"a {docs.BEGIN} old {docs.END} b"
    new = docs.splice(text, "new")
    assert new == f"a {docs.BEGIN}\nnew\n{docs.END} b" and docs.stale(text, "new") and not docs.stale(new, "new")
    with pytest.raises(ValueError):
        docs.splice("no marks", "x")
    assert docs.wrap("aa bb cccccccc d", 5) == ["aa bb", "cccccccc", "d"]


def test_answers_of_services():
    assert services.answers({"a": 1, "b": None}, ["a", "b", "c"]) == {"a": 1}
    works = {"results": [{"doi": "https://doi.org/10.1/A", "n": 5}, {"doi": "10.1/b"}, {"doi": None}]}
    assert services.answers(works, ["10.1/a", "10.1/B", "10.1/c"], "results", "doi") == {"10.1/a": works["results"][0], "10.1/B": works["results"][1]}
    assert services.answers([{"x": 1}, None], ["p", "q"], key="#") == {"p": {"x": 1}}
    assert services.answers(None, ["p"], "results", "doi") == {}
    slow = services._Reader({"ids": json.dumps(["a", "b", "c"]), "batch": "2", "pause": "3"})
    assert [p.batches for p in slow.partitions()] == [[["a", "b"], ["c"]]]


def test_service_payloads(spark):
    one = lambda body, **more: spark.createDataFrame([(json.dumps(body) if body is not None else None, *more.values())], ", ".join(["body string", *(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in more.items())]))
    rec = {"result": {"uids": ["7"], "7": {"uid": "7", "title": "T", "pubdate": "2019 Mar", "authors": [{"name": "Doe J"}], "source": "Brain"}}}
    assert services.summary_records(one(rec, uid="PMC7")).head().asDict() == {"id": "PMC7", "status": "hit", "title": "T", "year": "2019", "first_author": "Doe J", "journal": "Brain"}
    assert [services.summary_records(one(b, uid="8")).head()["status"] for b in (rec, None, {})] == ["miss", "transient", "miss"]
    assert services.search_hits(one({"esearchresult": {"idlist": ["5", "6"]}})).head()["hit"] == "5"
    assert services.search_hits(one({"esearchresult": {}})).head()["hit"] is None
    page = {"results": [{"doi": "https://doi.org/10.1/A", "cited_by_count": 3}, {"doi": "https://doi.org/10.1/a", "cited_by_count": 9}, {"doi": None, "cited_by_count": 1}, {"doi": "10.1/z"}]}
    assert [tuple(r) for r in services.work_counts(one(page)).collect()] == [("10.1/a", 9)]
    assert one({"cited_by_count": 0}).select(services.single_count(F.col("body"))).head()[0] == 0
    batch = one([{"citationCount": 4, "influentialCitationCount": 1}, None, {"citationCount": None}], ids=["a", "b", "c"])
    assert [tuple(r) for r in services.positional_counts(batch).collect()] == [("a", 4, 1)]
    people = {"results": [{"id": "https://x/A1", "display_name": "Ada", "orcid": "https://orcid.org/0-1", "works_count": 2, "cited_by_count": 3, "last_known_institutions": [{"display_name": "U"}], "counts_by_year": [{"year": 2020}, {"year": 1970}]}]}
    a = services.author_candidates(one(people)).head()
    assert (a["author_id"], a["orcid"], a["institutions"], a["first_year"], a["last_year"], a["merged"], a["only"]) == ("A1", "0-1", ["U"], 1970, 2020, True, True)


def test_works_pages(spark):
    from marginalia.operators import lab

    work = {
        "id": "W1", "doi": "https://doi.org/10.1/a", "title": "On sleep", "publication_year": 2020, "cited_by_count": 2, "type": "article", "topics": [{"display_name": "Sleep"}], "primary_location": {"source": {"display_name": "Brain"}},
        "abstract_inverted_index": {"b": [1], "a": [0]}, "authorships": [{"author": {"display_name": "Rosa de Heer"}}, {"author": {"display_name": ""}}], "biblio": {"volume": "3", "issue": "", "first_page": "7", "last_page": ""},
    }
    bodies = {"%2A": {"results": [work], "meta": {"next_cursor": "n+"}}, "n%2B": {"results": [], "meta": {"next_cursor": None}}}
    waits = []
    pages = list(services.cursor_pages(lambda url: json.dumps(bodies[url[2:]]).encode(), "u/{cursor}", waits.append))
    assert len(pages) == 2 and waits == [0.3]
    w = services.works(spark.createDataFrame([(p,) for p in pages], "body string")).withColumn("row_pos", F.lit(1))
    assert (w.head()["summary"], w.head()["pages"], w.head()["volume"]) == ("a b", "7", "3")
    assert lab.paper_rows(w).head()["apa"] == "de Heer, R. (2020). On sleep. Brain, 3, 7."


def test_post_batch():
    waits, calls = [], []

    def opener(request, timeout):
        calls.append(request.data)
        if len(calls) < 3:
            raise urllib.error.HTTPError("u", 429, "later", {}, None)
        return io.BytesIO(b"[1]")

    assert services.post_batch("http://x", ["a"], "me", opener, wait=waits.append) == "[1]" and waits == [15, 30]
    calls.clear()
    assert services.post_batch("http://x", ["a"], "me", opener, tries=2, wait=waits.append) is None


def test_figure_gate_ticks_and_arrows(spark):
    pts = spark.createDataFrame([("a", 0.1, 0.0, "R1", "Doe 2000"), ("a", 0.9, 0.0, "R2", None)], "family string, x double, offset double, ref string, label string")
    with pytest.raises(ValueError, match="nothing to plot"):
        reports.figure(pts, ["b"])
    svg = reports.figure(pts, ["a"], axis={2000: 0.1, 2010: 0.9}, arrows=[("R1", "R2", "red", "x"), ("R1", "R9", "red", "y")], emphasis=frozenset({"R2"}))
    assert ">2000</text>" in svg and svg.count("<path") == 1 and svg.count("stroke-width") == 1 and "Doe 2000" in svg


def test_an_unreadable_table_stops_a_gated_batch(spark, tmp_path):
    """Only a missing table counts as empty: one whose files can't be read must not let repeated keys through."""
    path = tmp_path / "t"
    assert batches.epochs(spark, str(path), 5) == []
    (path / "epoch=-1").mkdir(parents=True)
    (path / "epoch=-1" / "part.parquet").write_bytes(b"no parquet")
    (path / "epoch=7").mkdir()
    assert batches.epochs(spark, str(path), 5) == [-1]
    src = tmp_path / "in"
    spark.createDataFrame([("A",)], "ref string").write.parquet(str(src))
    stream = spark.readStream.schema("ref string").parquet(str(src))
    query = batches.gated_append(stream, str(path), str(tmp_path / "r"), str(tmp_path / "c")).trigger(availableNow=True).start()
    with pytest.raises(Exception):
        query.awaitTermination(60)
