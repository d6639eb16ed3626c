import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.operators import canonical, citecheck, counts, duplicates, families, graph, lab, layout, ranking, reconcile, references, verify


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_graph(spark):
    e = spark.createDataFrame([("a", "d1", 1), ("a", "d1", 2), ("a", "d2", 3), ("b", "d1", 4), ("b", "", 5), ("b", None, 6)], "citing string, cited string, pos int")
    f = graph.citation_frequency(e)
    assert rows(f.select("cited", "n_citations", "cited_by")) == [("d1", 2, ["a", "b"]), ("d2", 1, ["a"])]
    ranked = graph.ranked_candidates(f, spark.createDataFrame([("d1",)], "cited string"), "cited", 1)
    assert [r["cited"] for r in ranked.collect()] == ["d2"]
    corpus = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    links = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "a"), ("b", "a")], "citing string, cited string")
    assert rows(graph.indegree(corpus, links)) == [("a", 1), ("b", 1), ("c", 0)]


def test_midrank(spark):
    y = spark.createDataFrame([(1,), (1,), (3,), (9,), (None,)], "y int")
    assert {r["y"]: r["cdf"] for r in ranking.midrank_cdf(y, "y").collect()} == {1: 0.25, 3: 0.625, 9: 0.875}


def test_last_first_numbered(spark):
    df = spark.createDataFrame([("x", 1, 2000), ("x", 2, 1999), ("y", 3, None), (None, 4, 2001)], "k string, row_pos int, year int")
    assert rows(ranking.first_by_key(df, "k").select("row_pos")) == [(1,), (3,), (4,)]
    assert rows(ranking.last_by_key(df, "k").where("k = 'x'").select("row_pos")) == [(2,)]
    n = ranking.numbered(df, "label", F.coalesce("year", F.lit(0)), F.col("row_pos"))
    assert {r["row_pos"]: r["label"] for r in n.collect()} == {3: "L1", 2: "L2", 1: "L3", 4: "L4"}


def test_landmarks_cap(spark):
    p = spark.createDataFrame([(f"R{i:02d}", "f", i == 0, i, i) for i in range(40)], "ref string, family string, is_lab boolean, indegree bigint, cites bigint")
    got = ranking.landmarks(p, max_labels=10).collect()
    assert len(got) == 10 and {"R00", "R39", "R38"} <= {r["ref"] for r in got} and got[0]["capped"]
    assert ranking.landmarks(p, motif_min=38, max_labels=10).count() == 5


def test_families(spark):
    fams = spark.createDataFrame([("infer", "Inference", 1), ("act", "Acting", 2)], "key string, name string, pos int")
    a = spark.createDataFrame([("1", "Infer "), ("2", "ACTING"), ("3", "other"), ("4", None)], "ref string, family_raw string")
    got = families.resolve(a, fams)
    assert rows(got.select("ref", "family")) == [("1", "infer"), ("2", "act"), ("3", "other"), ("4", None)]
    v = families.violations(spark.createDataFrame([("1",), ("9",)], "ref string"), got, fams)
    assert {(r["gate"], r["item"]) for r in v.collect()} >= {("missing", "9"), ("extra", "2"), ("unknown-key", "other")}
    b = spark.createDataFrame([("a",)] * 6 + [("b",)] * 4, "f string")
    assert {r["family"]: r["warning"] for r in families.balance(b, F.col("f")).collect()} == {"a": None, "b": None}
    assert {r["family"]: r["warning"] for r in families.balance(b.union(b.where("f='a'")), F.col("f")).collect()}["a"] == "dominant"
    t = spark.createDataFrame([("A. Vision",), ("Multimodal nets",), ("Multisensory",), ("",), (None,)], "topic string")
    assert {r["topic"]: r["code"] for r in families.topic_codes(t).collect()} == {"A. Vision": "A", "Multimodal nets": "Mult", "Multisensory": "Mult2", "": "?"}


def test_counts(spark):
    c = spark.createDataFrame([("k", 6, 700, 1, "a"), ("k", None, 3, None, "b"), ("z", 0, None, 0, None)], "key string, openalex bigint, s2 bigint, s2_influential bigint, asof string")
    best = counts.max_wins(c)
    assert rows(best.select("key", "openalex", "s2")) == [("k", 6, 700), ("z", 0, None)]
    canon = spark.createDataFrame([("k", 667), ("z", 9)], "key string, count bigint")
    assert rows(counts.reconciled(best, canon).select("key", "openalex", "corrected")) == [("k", 667, True), ("z", 0, False)]
    r = spark.createDataFrame([("k", 3, 1), ("q", 3, None)], "ref string, cite_openalex bigint, cite_s2 bigint")
    assert rows(counts.attach(r, best, "ref")) == [("k", 6, 700, True), ("q", 3, None, False)]
    with pytest.raises(KeyError):
        counts.attach(r, best.withColumnRenamed("openalex", "oa"), "ref")


def test_verdicts(spark):
    c = spark.createDataFrame([("1", "d1", "Tang", "2023"), ("2", "d2", "Tang", "2020"), ("3", "d3", "Lee", ""), ("4", "dx", "A", ""), ("5", "d5", "A", ""), ("6", "d6", "Lee", "in press")], "label string, doi string, expect_first_author string, expect_year string")
    one = spark.createDataFrame([("d1", "hit", "Tang J", "2024"), ("d2", "hit", "Tang J", "2023"), ("d3", "hit", "Leeson A", "1"), ("d5", "transient", None, None), ("d6", "transient", None, None)], "id string, status string, first_author string, year string")
    two = spark.createDataFrame([("d6", "hit", "Wong", "2000")], "id string, status string, first_author string, year string")
    got = {r["label"]: (r["verdict"], r["source"]) for r in verify.verify(c, [("x", "doi", one), ("y", "doi", two)]).collect()}
    assert got == {"1": ("OK", "x"), "2": ("MISMATCH", "x"), "3": ("OK", "x"), "4": ("NOT-FOUND", None), "5": ("ERROR", None), "6": ("MISMATCH", "y")}


def test_citation_resolution(spark):
    refs = spark.createDataFrame([("A1", "Farb, N., Segal, Z., & Mayberg, H. (2007). T. V."), ("A2", "Kral, T., Davis, K., & Korponay, C. (2022). T. V."), ("A3", "Kral, T., Lapate, R., & Imhoff-Smith, T. (2022). T. V."), ("A4", "Millière, R. (2018). T. V.")], "ref string, apa string")
    text = spark.createDataFrame([("(Farb et al., 2007) (Kral et al., 2022) (Kral, Davis, et al., 2022) (Milliere, 2018) (Nobody, 1999)",)], "t string")
    got = {r["citation"]: (r["status"], r["first_ref"]) for r in citecheck.resolve(text, "t", refs).collect()}
    assert got == {"Farb et al., 2007": ("ok", "A1"), "Kral et al., 2022": ("ambiguous", "A2"), "Kral, Davis, et al., 2022": ("ok", "A2"), "Milliere, 2018": ("ok", "A4"), "Nobody, 1999": ("unresolved", None)}
    with pytest.raises(ValueError, match="Nobody"):
        citecheck.gate(citecheck.resolve(text, "t", refs))


def test_duplicates_match_brute_force(spark):
    import difflib
    import random
    import re

    random.seed(4)
    base = ["effects of sleep on memory in mice", "a study of attention", "short", "attention: a study of it", "memory of sleep effects in rats"]
    data = [(i, "".join(c for c in random.choice(base) if random.random() > 0.06).title(), random.choice(["https://doi.org/10.48550/x", "u", None])) for i in range(60)] + [(60, None, "U"), (61, "", "U")]
    df = spark.createDataFrame(data, "row_pos int, title string, link string")
    norm = {i: re.sub("[^a-z0-9 ]", "", (t or "").lower()) for i, t, _ in data}
    want = set()
    for a in range(60):
        for b in range(a + 1, 60):
            x, y = norm[a], norm[b]
            if x and y and abs(len(x) - len(y)) <= 0.35 * max(len(x), len(y)) and difflib.SequenceMatcher(None, x, y).ratio() >= 0.88:
                want.add((a, b))
    got = duplicates.similar_titles(df).collect()
    assert {(r["a"], r["b"]) for r in got} == want
    assert {(r["a"], r["b"]) for r in duplicates.same_link(df).collect()} >= {(60, 61)}


def test_reconcile(spark):
    files = spark.createDataFrame([("nrn755.pdf",), ("x.pdf",), ("1-s2.0-S0042698911001544-main.pdf",)], "file string")
    m = spark.createDataFrame([("a", "10.1038/nrn755"), ("b", "10.1016/S0042698911001544"), ("c", None)], "slug string, doi string")
    assert rows(reconcile.filename_matches(files, m)) == [("1-s2.0-S0042698911001544-main.pdf", "b"), ("nrn755.pdf", "a")]
    s = spark.createDataFrame([("p", "a", 0.80), ("p", "b", 0.70), ("q", "a", 0.8), ("r", "a", 0.9), ("r", "b", 0.7)], "page string, slug string, score double")
    assert rows(reconcile.best_with_margin(s, "page").select("page", "slug", "decision")) == [("p", None, "tie"), ("q", "a", "match"), ("r", "a", "match")]
    pages = spark.createDataFrame([("p", "A great TANGLE of memory and attention, 2020."), ("q", None)], "page string, text string")
    man = spark.createDataFrame([("a", "Memory and attention", "Tang J", "2020"), ("b", "Memory and attention", "Tang", "1999"), ("c", None, None, None)], "slug string, title string, first_author string, year string")
    assert rows(reconcile.text_matches(pages, man, "page", "text")) == [("p", "a", 1.1)]


def test_text_matches_take_short_names(spark):
    titles = ["Memory and attention networks", "Deep tangle of memory", "Signals without border control"]
    man = [(f"{au}{yr}{k}", t, f"{au} Rest", yr) for au in ("de", "De", "o", "王", "li", "tang", "d.") for yr in ("2020", "202", "", None) for k, t in enumerate(titles)]
    texts = ["Jan de Vries: memory and attention, networks of 12020", "Modern tangle of MEMORY, deep 1999", "王 signals, border control 2020", " " * 1600 + "Lima: attention memory 2020", "x" * 2999 + " de memory attention 2020", "", None]

    def norm(s):
        return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", s.lower())).strip()

    want = set()
    for i, text in enumerate(texts):
        raw = (text or "")[:3000]
        for slug, title, author, yr in man:
            au, words = author.lower().split()[0], [w for w in norm(title).split() if len(w) >= 4 and w not in reconcile.STOP]
            hits = sum(w in norm(raw) for w in words)
            if au in norm(raw) and (yr or "") in raw and hits >= 2 and hits / len(words) >= 0.25:
                want.add((i, slug, round(hits / len(words) + 0.1 * (norm(raw).find(au) < 1500), 6)))
    got = reconcile.text_matches(spark.createDataFrame(list(enumerate(texts)), "page int, text string"), spark.createDataFrame(man, "slug string, title string, first_author string, year string"), "page", "text")
    assert {s[:2] for _, s, _ in want} >= {"de", "De", "li"} and any(s[0] == "王" for _, s, _ in want)
    assert rows(got) == sorted(want, key=repr)


def _text_tables(spark):
    titles = ["Memory and attention networks", "Memory of attention", "Deep tangle of memory", "Attention networks without memory"]
    man = spark.createDataFrame([(f"{au}{k:03d}", titles[k % 4], au, "2020" if k % 3 else None) for au in ("de", "tang", "van") for k in range(40)], "slug string, title string, first_author string, year string")
    texts = ["de Tang: memory and attention networks 2020", "van Vries: attention to memory, a deep tangle", "x" * 10, "Tangle of memory, 2020, deep van de"]
    return spark.createDataFrame(list(enumerate(texts)), "page int, text string"), man


def test_text_pairs_are_never_joined(spark):
    """Pages don't meet titles in a join, whose pairs would be moved with the words of both; parts of the vocabulary and several tasks a name change nothing."""
    pages, man = _text_tables(spark)
    whole = reconcile.text_matches(pages, man, "page", "text")
    assert "Join" not in whole._jdf.queryExecution().toString() and whole.count() > 100
    kept = reconcile.PART, reconcile.TITLES
    try:
        reconcile.PART, reconcile.TITLES = 3, 7
        assert rows(reconcile.text_matches(pages, man, "page", "text")) == rows(whole)
    finally:
        reconcile.PART, reconcile.TITLES = kept


def test_best_match_from_the_best_of_every_name(spark):
    pages, man = _text_tables(spark)
    whole, some = (reconcile.text_matches(pages, man, "page", "text", best=b) for b in (None, 2))
    assert some.count() < whole.count() // 5
    assert rows(reconcile.best_with_margin(some, "page")) == rows(reconcile.best_with_margin(whole, "page"))


def test_claims_do_not_move_every_match(spark):
    """Best matches are claimed from a page's best ones: the only join of the query is that with the documents' dates."""
    from marginalia.plans.queries import slug_claims

    plan = slug_claims(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1


def test_pages_take_along_only_words_of_a_name(spark, monkeypatch):
    """A page that names many papers goes to each author name with the words of that name's titles, not with all of its words."""
    import pyarrow as pa

    def sent(*args):
        schema = args[-1]

        def run(batches):
            for b in batches:
                b = b.filter(b.column(2))
                n = [float(sum(len(x) // 4 if isinstance(x, bytes) else 1 for x in ids)) for ids in b.column(5).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(7), pa.nulls(len(n), pa.string()), pa.array(n, pa.float64())], schema=schema)

        return run

    letters = "abcdefghijklmnopqrst"
    man = spark.createDataFrame([(f"s{c}", f"{c}once {c}{c}twice {c}thrice", f"{c}author", "2020") for c in letters], "slug string, title string, first_author string, year string")
    pages = spark.createDataFrame([(1, " ".join(f"{c}once {c}{c}twice {c}thrice" for c in letters) + " aauthor and bauthor, 2020"), (2, "cauthor 2020: aonce, aatwice")], "page int, text string")
    assert rows(reconcile.text_matches(pages, man, "page", "text")) == [(1, "sa", 1.1), (1, "sb", 1.1)]
    monkeypatch.setattr(reconcile, "_scored", sent)
    assert rows(reconcile.text_matches(pages, man, "page", "text").select("page", "score")) == [(1, 3.0), (1, 3.0)]


def test_titles_met_by_pages_together_or_year_by_year(monkeypatch):
    rng = random.Random(7)
    titles = [(f"s{k}", rng.randrange(4), np.array([rng.randrange(40) * 3 for _ in range(rng.randrange(2, 12))], np.int32)) for k in range(90)]
    known = sorted({int(w) for _, _, ids in titles for w in ids})
    pages = [(sorted(rng.sample([0, 1, 3], rng.randrange(1, 4))), sorted(rng.sample(known, rng.randrange(1, 20)))) for _ in range(50)]
    t = reconcile._Titles([x for x in titles if x[1] != 2])
    flat = [np.array([(k, x) for k, page in enumerate(pages) for x in page[i]]).T for i in (0, 1)]
    want = sorted((k, slug, sum(int(w) in ids for w in ws)) for k, (years, ids) in enumerate(pages) for slug, y, ws in titles if y in years if (h := sum(int(w) in ids for w in ws)) >= 2 and h * 4 >= len(ws))
    for few in (10_000, -1):
        monkeypatch.setattr(reconcile, "FEW", few)
        page, title, hits = t.met(len(pages), *flat[0], *flat[1])
        assert page.tolist() == sorted(page.tolist()) and sorted(zip(page.tolist(), [t.slugs[x] for x in title], hits.tolist())) == want


def test_a_word_twice_in_a_title_counts_twice(spark):
    man = spark.createDataFrame([("a", "Memory, memory", "Tang", "2020"), ("b", "Memory of others", "Tang", "2020"), ("c", "Memory, memory", "Lee", None)], "slug string, title string, first_author string, year string")
    pages = spark.createDataFrame([(1, "tang lee memory 2020"), (2, "lee memory"), (3, "tang lee 2020")], "page int, text string")
    assert rows(reconcile.text_matches(pages, man, "page", "text")) == [(1, "a", 1.1), (1, "c", 1.1), (2, "c", 1.1)]


def test_text_matches_delete_what_they_wrote(spark):
    """Of the pages and titles written between parts of the vocabulary, only the last stand once the plan is made."""
    pages, man = _text_tables(spark)
    whole, kept, folder = rows(reconcile.text_matches(pages, man, "page", "text")), reconcile.PART, Path(spark.conf.get("spark.checkpoint.dir"))
    there = set(folder.glob("cut-*"))
    try:
        reconcile.PART = 2
        got = reconcile.text_matches(pages, man, "page", "text")
        assert len(set(folder.glob("cut-*")) - there) == 2
        assert rows(got) == whole
    finally:
        reconcile.PART = kept


def test_hot_pieces_of_file_names(spark):
    """Pairs of hot pieces and of others come out once each, papers without a slug too."""
    rng = random.Random(4)
    dois = [f"10.1/s10{rng.randrange(3)}({rng.randrange(80, 99)}){rng.randrange(90, 120):05d}" for _ in range(60)] + ["10.2/ab.2010.00095", "10.2/ab_2010_00096", "2010", None, "10.3/x", "10.2/AB-2010"]
    names = [f"s10{rng.randrange(3)}({rng.randrange(80, 99)}){rng.randrange(90, 120):05d}.PDF" for _ in range(40)] + ["2010.pdf", "ab_2010_00095.pdf", "00096", "dir/s102.pdf", "ab.pdf", "1-s2.0-S102-main.pdf"]
    papers = [(None if k % 17 == 5 else f"p{k}", d) for k, d in enumerate(dois)]

    def forms(f):
        s = re.sub(r"(?<=.)\.[^.]*$", "", f.split("/")[-1].lower())
        e = re.search(r"1-s2\.0-(s\d+)-main", s)
        return {s, s.replace("_", "-"), s.replace("_", "."), *([e.group(1)] if e else [])}

    def pieces(d):
        x = d.lower().split("/", 1)[-1]
        return {x, x.replace(".", "_"), *re.findall(r"([a-z]*\d{3,}[a-z\d\-_.]*)", x)}

    want = {(f, slug) for f in names for slug, d in papers if d for s in forms(f) for p in pieces(d) if min(len(s), len(p)) >= 4 and (s in p or p in s)}
    kept = reconcile.HOT
    try:
        for reconcile.HOT in (2, 10, 10_000):
            got = reconcile.filename_matches(spark.createDataFrame([(n,) for n in names], "file string"), spark.createDataFrame(papers, "slug string, doi string"))
            assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    finally:
        reconcile.HOT = kept
    assert any(s is None for _, s in want) and len(want) > 500


def test_references(spark):
    df = spark.createDataFrame([(1, "Zeidan, F. (2015). Does it work?", "l1"), (2, "Millière, R. (2018). T. V", "l2"), (3, " Miller, A. (2000). T. V. ", "l3"), (4, "Miller, A. (2000). T. V.", "l4"), (5, "", "l5"), (6, None, None)], "row_pos int, apa string, link string")
    got = references.reference_list(df).orderBy("sort_key", "first_pos").collect()
    assert [(r["reference"], r["link"]) for r in got] == [("Miller, A. (2000). T. V.", "l3"), ("Millière, R. (2018). T. V.", "l2"), ("Zeidan, F. (2015). Does it work?", "l1")]
    t = spark.createDataFrame([("a", 1)], "ref string, x int")
    assert references.append(t, spark.createDataFrame([("b",)], "ref string")).count() == 2
    with pytest.raises(ValueError, match="present"):
        references.append(t, t)


def test_layout_and_lab(spark):
    assert layout.swarm([0, 0, 0]) == [0, 11.2, -11.2]
    df = spark.createDataFrame([("u", ["https://europepmc.org/1", "u", "v", None])], "b string, o array<string>")
    assert df.select(lab.download_candidates(F.col("b"), F.col("o"))).head()[0] == ["u", "v", "https://europepmc.org/1"]
    s = spark.createDataFrame([("search", "Smith, A., & Lee, B. (2000). Jones"), ("lab", None), (None, "Smithson, A. (2000)")], "s string, a string")
    assert [r[0] for r in s.select(lab.is_lab(F.col("s"), F.col("a"), ["smith"])).collect()] == [True, True, False]


def test_canonical(spark):
    r = spark.createDataFrame(
        [(1, "10.1/X", None, None, "old", None, None), (2, "10.48550/arXiv.5v2", None, None, "old", None, "V"), (3, None, None, None, "old", "2020", None), (4, "10.1/t", None, None, "old", None, None)],
        "row_pos int, doi string, link string, arxiv string, apa string, canonical_at string, venue string",
    ).withColumn("source", F.lit("search"))
    rec = spark.createDataFrame(
        [("crossref", "10.1/x", "hit", ["A, B."], "2001", "WHY?", "J", "1", None, None), ("arxiv", "5", "hit", ["C, D."], "2002", "T", None, None, None, None), ("crossref", "10.1/t", "transient", None, None, None, None, None, None, None)],
        "source string, id string, status string, people array<string>, year string, title string, journal string, volume string, issue string, pages string",
    )
    assert {x["source"] for x in canonical.rebuild(r, rec, "2024-01-01").collect()} == {"search"}
    got = {x["row_pos"]: (x["canon_status"], x["apa"], x["canonical_at"]) for x in canonical.rebuild(r, rec, "2024-01-01").collect()}
    assert got == {1: ("rebuilt", "A, B. (2001). Why? J, 1.", "2024-01-01"), 2: ("rebuilt", "C, D. (2002). T. V.", "2024-01-01"), 3: ("no-source", "old", "2020"), 4: ("transient", "old", None)}


def test_labels_and_ticks(spark):
    assert layout.place_labels([(0, 0, "abc"), (5, 0, "abc")]) == [-18, -33]
    assert layout.ticks(1998, 2020, lambda y: y * 10, True) == [2000, 2005, 2010, 2015, 2020]
    assert layout.ticks(1950, 2020, lambda y: y, False) == [1950, 1990]
    pos = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "ref string, x double, y double")
    spec = spark.createDataFrame([("a", "b"), ("a", "z")], "`from` string, `to` string")
    assert [(r["x1"], r["x2"]) for r in layout.arrows(spec, pos).collect()] == [(1.0, 3.0)]
    pts = spark.createDataFrame([("f", "a", 0.0), ("f", "b", 0.0)], "lane string, ref string, x double")
    assert sorted(r["offset"] for r in layout.big_dots(pts, "lane", "x", "ref", True).collect()) == [0.0, 24.0]


def test_numbers_fit_beyond_the_sample_of_range_bounds(spark):
    """More rows than a range partitioner samples, and columns beyond the order's."""
    df = spark.range(0, 600_000, 1, 4).select(((F.col("id") * 7919) % 600_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("extra"))
    got = ranking.ranked(df, "n", F.col("k")).agg(F.count_if(F.col("n") == F.col("k") + 1), F.count_distinct("n")).head()
    assert tuple(got) == (600_000, 600_000)


def test_ranked_candidates(spark):
    c = spark.createDataFrame([("a", 3, 5), ("b", 9, 7), ("c", 3, 1), ("d", 1, 1), ("e", 8, 1)], "doi string, n_citations bigint, first_pos bigint")
    got = graph.ranked_candidates(c, spark.createDataFrame([("e",)], "doi string"), "doi").collect()
    assert {r["doi"]: r["rank"] for r in got} == {"b": 1, "c": 2, "a": 3}


def test_crowded_place_stands_on_the_last_rung(spark):
    pts = spark.createDataFrame([("l", 2000.0, f"{i:03d}") for i in range(60)], "lane string, x double, tie string")
    got = {r["tie"]: r["offset"] for r in layout.beeswarm(pts, "lane", "x", "tie").collect()}
    assert [got[f"{i:03d}"] for i in range(60)] == layout.swarm([2000.0] * 60)


def test_gates_raise(spark):
    from marginalia.operators import families, references

    rows = spark.createDataFrame([(1, "R1", "Doe, A. Title. Venue.", None, None, None), (2, "R2", "Doe, A. (2000). Title. Venue.", None, None, None)], "row_pos int, ref string, apa string, doi string, link string, arxiv string")
    with pytest.raises(ValueError, match="no-year"):
        references.gate(references.findings(rows))
    references.gate(references.findings(rows.where("row_pos = 2")))
    fams = spark.createDataFrame([("x",), ("y",)], "key string")
    assigned = spark.createDataFrame([("R1", "x"), ("R3", "z")], "ref string, family string")
    with pytest.raises(ValueError, match="missing: \\['R2'\\]"):
        families.gate(families.violations(rows, assigned, fams))
    families.gate(families.violations(rows.where("ref = 'R1'"), assigned.where("ref = 'R1'"), fams))


def test_similar_titles_match_brute_force(spark, monkeypatch):
    """Blocks of a few titles give what comparing every title with every other gives, both ways of the order-dependent ratio."""
    import difflib
    import random

    monkeypatch.setattr(duplicates, "BLOCK", 7)
    rng = random.Random(9)
    words = "sleep memory attention reward of the in and a study mice humans model networks during learning".split()
    titles = []
    for i in range(60):
        base = " ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) if i % 2 or not titles else rng.choice(titles)
        cut = rng.randrange(len(base))
        titles.append(base if rng.random() < 0.3 else base[:cut] + rng.choice("xyz ") + base[cut + rng.randint(0, 2) :])
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(titles)] + [(99, None, None), (98, "", None), (97, "?!", None)], "row_pos int, title string, link string")
    got = {(r["a"], r["b"]): r["ratio"] for r in duplicates.similar_titles(df).collect()}
    want = {}
    for i, x in enumerate(titles):
        for j, y in enumerate(titles[i + 1 :], i + 1):
            ratio = difflib.SequenceMatcher(None, x, y).ratio()
            if ratio >= 0.88 and abs(len(x) - len(y)) <= 0.35 * max(len(x), len(y)):
                want[i, j] = round(ratio, 6)
    assert got == want and len(want) > 20
