import random
from collections import Counter, defaultdict

from marginalia.llm import frequency, topn


def test_top_n_matches_brute_force(spark):
    random.seed(1)
    data = [(random.choice("abcde") if random.random() < 0.6 else "hot", f"i{k % 700}", random.choice([None, 1, 2, 3]), k) for k in range(3000)]
    data += [(None, "x", 9, 1), ("a", None, 9, 2), ("a", "x", 9, None)]
    df = spark.createDataFrame(data, "g string, i string, s int, p int").withColumnRenamed("s", "score").selectExpr("g", "i", "score", "p", "1 as rank", "'z' as n")
    best = defaultdict(dict)
    for g, i, s, p in data:
        if None not in (g, i, p):
            key = (s if s is not None else -1, -p)
            best[g][i] = max(best[g].get(i, key), key)
    for n in (1, 5, 900):
        want = {(g, i) for g, items in best.items() for i in sorted(items, key=lambda i: (-items[i][0], -items[i][1], i))[:n]}
        got = topn.top_n(df.repartition(7), "g", "i", "score", "p", n)
        assert {(r["g"], r["i"]) for r in got.collect()} == want
    assert topn.top_n(df.limit(0), "g", "i", "score", "p").count() == 0


def test_rows_are_cut_where_they_lie(spark):
    """Of a group that holds everything only n rows a partition survive the bounds; items that lie by their hash move once."""
    df = spark.range(0, 20_000, 1, 8).selectExpr("'hot' as g", "cast(id as string) as i", "id % 977 as score", "id as p")
    got = topn.top_n(df, "g", "i", "score", "p", 3)
    assert [(r["score"], r["p"]) for r in got.orderBy("rank").collect()] == [(976, 976), (976, 1953), (976, 2930)]
    plan = topn.top_n(df.repartition(4, "i"), "g", "i", "score", "p", 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan or "rank" in plan


def test_family_top_refs(spark):
    rows = spark.createDataFrame([(1, " Infer", "A"), (2, "infer", "B"), (3, "INFER ", "A"), (4, "", "C"), (5, None, "D"), (6, "solo", "E")], "row_pos bigint, family string, ref string")
    counts = spark.createDataFrame([("A", 1, None), ("A", None, 7), ("B", 7, 0), ("Z", 1, 1), (None, 5, 5)], "key string, openalex bigint, s2 bigint")
    got = [tuple(r) for r in topn.family_top_refs(rows, counts, 2).orderBy("family", "rank").collect()]
    assert got == [("infer", "A", 7, 1, 1), ("infer", "B", 7, 2, 2), ("solo", "E", -1, 6, 1)]


def test_frequency_splits_hot_terms(spark):
    random.seed(2)
    data = [("hot" if random.random() < 0.4 else f"t{random.randint(0, 60)}", f"r{random.randint(0, 200)}") for _ in range(4000)]
    data += [(None, "r"), ("only", None), ("", "r1")]
    df = spark.createDataFrame(data, "term string, record string").selectExpr("term", "record", "1 as n", "2 as ht", "3 as piece")
    records, entries = defaultdict(set), Counter()
    for t, r in data:
        if t is not None:
            records[t].add(r)
            entries[t] += 1
    want = {(t, len(records[t]), entries[t]) for t in entries}
    for limit in (10, 100, 10**6):  # small limits split by term, then by record
        got = frequency.term_frequency(df, "term", "record", max_piece_rows=limit, memory="64MB")
        assert {tuple(r) for r in got.collect()} == want
    assert frequency.term_frequency(df.limit(0), "term", "record").count() == 0


def test_doi_marks(spark):
    data = [(f"s{i}", " https://doi.example/10.1/Common.") for i in range(100)] + [("s1", "10.1/rare"), ("s1", "doi: 10.1/RARE"), ("s1", "10.1/two"), ("s2", "10.1/two"), ("s3", None), ("s3", ""), (None, "10.1/two"), (None, "10.1/none")]
    got = {r["doi"]: (r["records"], r["entries"], r["mark"]) for r in frequency.doi_frequency(spark.createDataFrame(data, "slug string, doi string")).collect()}
    assert got == {"10.1/common": (100, 100, "common"), "10.1/rare": (1, 2, "rare"), "10.1/two": (2, 3, None), "10.1/none": (0, 1, None)}
