from pyspark.sql import functions as F

from marginalia.functions import apa, audit, citekeys, names, titles
from marginalia.functions import doi as D


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return df.select(col.alias("x")).head()["x"]


def many(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_person(spark):
    cases = [
        ("(Bud) Craig", "A. D.", "Craig, A. D."), ("ANDERSON", "J.", "Anderson, J."), ("Huber", "L. (Renzo)", "Huber, L. R."), ("King", "Jean-Rémi", "King, J.-R."),
        ("A. Moffat", "Bradford", "Moffat, B. A."), ("van den Heuvel", "M. P.", "van den Heuvel, M. P."), ("Lambon Ralph", "M. A.", "Lambon Ralph, M. A."), ("zhang", "", "Zhang"),
    ]
    df = spark.createDataFrame(cases, "f string, g string, want string")
    for r in df.select("want", names.person(F.col("f"), F.col("g")).alias("got")).collect():
        assert r["got"] == r["want"]


def test_split_name(spark):
    got = many(spark, names.split_name, ["Martijn van den Heuvel", "Plato", "van Gogh", "", None, "Ana de la Cruz"])
    assert [g and (g["family"], g["given"]) for g in got] == [("van den Heuvel", "Martijn"), ("Plato", ""), ("Gogh", "van"), ("", ""), ("", ""), ("de la Cruz", "Ana")]


def test_join_authors(spark):
    people = [f"A{i}, B." for i in range(21)]
    assert one(spark, names.join_authors(F.col("p")), p=people) == ", ".join(people[:19]) + ", … A20, B."
    assert one(spark, names.join_authors(F.col("p")), p=["A, B.", "C, D."]) == "A, B., & C, D."
    assert one(spark, names.join_authors(F.col("p")), p=[]) == "Anon."


def test_build_apa(spark):
    def ref(people, year, title, journal, v=None, i=None, p=None):
        df = spark.createDataFrame([(people, year, title, journal, v, i, p)], "people array<string>, year int, title string, journal string, v string, i string, p string")
        return df.select(titles.build_apa(*map(F.col, ("people", "year", "title", "journal", "v", "i", "p"))).alias("x")).head()["x"]

    assert ref(["Buckner, R. L."], 2008, "<i>The Brain's Default Network</i>", "Annals") == "Buckner, R. L. (2008). The Brain's Default Network. Annals."
    assert ref(["Friston, K."], 2010, "The free-energy principle: A unified brain theory?", "Nat Rev Neurosci").endswith("theory? Nat Rev Neurosci.")
    assert ref(["Andrews‐Hanna, J. R."], 2010, "T", "V", "1", "2", "3–4") == "Andrews-Hanna, J. R. (2010). T. V, 1(2), 3–4."
    assert ref(["A, B."], None, "T", None, "1") == "A, B. (n.d.). T."


def test_parse_apa(spark):
    texts = ["Yang, W., & Li, X. (2025a). A title: With subtitle? Venue, 1(1), 1-2.", "Biswal, B. (1995). Functional connectivity", "Yang, W. Title. Venue.", None, ""]
    got = many(spark, apa.parse_apa, texts)
    g = got[0]
    assert (g["authors"], g["year"], g["suffix"], g["title"], g["terminal"], g["rest"]) == ("Yang, W., & Li, X.", 2025, "a", "A title: With subtitle", "?", " Venue, 1(1), 1-2.")
    assert g["head"] + g["title"] + g["terminal"] + g["rest"] == texts[0]
    assert (got[1]["title"], got[1]["terminal"], got[1]["rest"]) == ("Functional connectivity", "", "")
    assert got[2:] == [None, None, None]
    assert many(spark, apa.lead_surname, ["van den Heuvel, M. P. (2010). T. V."]) == ["van den Heuvel"]


def test_identifiers(spark):
    df = spark.createDataFrame([(" 10.1/X ", None), (None, "https://doi.org/10.2/y"), (None, "https://x.org/1"), ("", None)], "doi string, link string")
    assert [r[0] for r in df.select(D.doi_of(F.col("doi"), F.col("link"))).collect()] == ["10.1/X", "10.2/y", None, None]
    assert many(spark, D.norm_doi, [" DOI: 10.1/A.", "http://dx.doi.example/10.1/a),", "", None, "10.1/a(b)c"]) == ["10.1/a", "10.1/a", None, None, "10.1/a(b)c"]
    assert many(spark, D.norm_arxiv, ["2305.1v12", " x "]) == ["2305.1", "x"]
    assert many(spark, lambda c: D.arxiv_id_of(F.lit(None).cast("string"), c), ["10.48550/ArXiv.2305.1", "10.1/x", None]) == ["2305.1", None, None]


def test_audit(spark):
    cases = {
        "Biswal, B. (1995). Functional connectivity. MRM, 34(4), 537-541.": [], "Yang, W. (2025a). Title. Venue, 1(1), 1-2.": [], "Yang, W. Title. Venue.": ["no-year"],
        "Yang, W. (2025a). THE FULLY UPPERCASE TITLE HERE. Venue, 1(1), 1-2.": ["uppercase-run"], "A, B. (2008). <i>T</i>. V, 1(1), 1-2.": ["markup-tag"], "F, K. (2010). A theory?. V, 1(1), 1-2.": ["double-terminal"],
        "Kabat‐Zinn, J. (1982). T. V, 1(1), 1-2.": ["unicode-hyphen"], "Huber, L. (., Ehses, P. (2025). T. V, 1(1), 1-2.": ["malformed-initial"], "Thomas Yeo, B. T. T. (2011). T. V, 1(1), 1-2.": [],
    }
    got = many(spark, lambda c: audit.defects(c, F.lit(False)), list(cases))
    assert got == list(cases.values())
    notes = many(spark, lambda c: audit.notes(c, F.lit(True)), ["Thomas Yeo, B. T. T. (2011). T. V.", "de Heer, W. A. (2017). T. V."])
    assert notes == [["multi-word surname: Thomas Yeo"], []]


def test_repair(spark):
    got = many(spark, audit.repair, ["A, B. (2008). <i>T</i>. V.", "F, K. (2010). A theory?. V.", "Kabat‐Zinn, J.  (1982).", "two  blanks stay", None])
    assert [g["fixed"] for g in got] == ["A, B. (2008). T. V.", "F, K. (2010). A theory? V.", "Kabat-Zinn, J. (1982).", "two  blanks stay", None]
    again = many(spark, audit.repair, [g["fixed"] for g in got])
    assert [g["changes"] for g in again[:3]] == [[], [], []]


def test_titles(spark):
    assert many(spark, titles.norm_title, ["An intensively <scp>MRI</scp> study", "ALL CAPS: a".upper(), "Aa &amp; B", None]) == ["An intensively MRI study", "All caps: A", "Aa & B", ""]
    assert many(spark, titles.clean_venue, ["PsyArXiv (OSF)", None, "A (b) c"]) == ["PsyArXiv", "", "A (b) c"]


def test_sentence_case():
    s = titles.sentence_case
    assert s("Effects Of Meditation Experience On Brain Networks") == "Effects of meditation experience on brain networks"
    assert s("Defining meditation: foundations for a system") == "Defining meditation: Foundations for a system"
    assert s("EEG And fMRI Evidence For DMN Change") == "EEG and fMRI evidence for DMN change"
    assert s("Resting-State Functional Connectivity") == "Resting-state functional connectivity"
    assert s("A Study Of ACAM-J And S-ART") == "A study of ACAM-J and S-ART"
    assert s("Evidence From 7T And COVID-19 Cohorts") == "Evidence from 7T and COVID-19 cohorts"
    assert s("Yoga And Sahaja Yoga Meditation", phrases=("Sahaja Yoga",)) == "Yoga and Sahaja Yoga meditation"
    assert s("Secondary Analyses From The Age-Well Trial", titles.PROPER | {"Age-Well"}) == "Secondary analyses from the Age-Well trial"


def test_citations(spark):
    text = "As shown (Farb et al., 2007; Kral, Davis, et al., 2022). Millière (2018) argued otherwise. (Smith, 2020, p. 4) (see Doe, 2021)"
    assert sorted(many(spark, citekeys.citations_in, [text])[0]) == sorted(["Farb et al., 2007", "Kral, Davis, et al., 2022", "Millière, 2018", "Smith, 2020", "see Doe, 2021"])
    keys = many(spark, citekeys.keys_for, ["A, B. (2000). T.", "A, B., & Cd, E. (2000b). T.", "No year", None])
    assert keys == [["A, 2000"], ["A & Cd, 2000b", "A et al., 2000b"], [], []]


def test_unabstract(spark):
    df = spark.sql("select map('b', array(1, 3), 'a', array(0)) m")
    assert df.select(titles.unabstract(F.col("m"))).head()[0] == "a b b"
