import random

import pytest

from marginalia.llm import names

REG = [
    ("1", "Nadia T. Jeskuskamer", "person"), ("2", "Élodie Golvimbeska", "person"), ("3", "Abigail Golvimbeska", "person"), ("4", "Anthony Grauvoglibry", "person"), ("5", "José van der Yarmandoška", "person"),
    ("6", "Kestermark Laboratory for Applied Perception", "org"), ("7", "Chidi Velundelio-Xilipondez", "person"), ("8", None, "person"), ("9", "Michael R. Uldovarlund", "person"), ("10", "Ivo A. Uldenzin", "person"),
]


def ids(hits):
    return [author_id for *_, author_id in hits]


@pytest.fixture(scope="module")
def reg():
    return names.build(REG)


def test_spellings(reg):
    cases = {
        "Nadia T. Jeskuskamer": "1", "JESKUSKAMER Nadia T.": "1", "Jeskuskamer, N.": "1", "NT Jeskuskamer": "1", "Nadia Jeskusakmer": "1", "Dr. Nadia Jeskuskamer, PhD": "1", "N​adia Jeskuskamеr": "1", "Golvimbeska, É.": "2",
        "E Golvimbeska": "2", "A. Golvimbeska": "3", "Tony Grauvoglibry": "4", "Anthony (Tony) Grauvoglibry": "4", "Grauvoglibry “Tony”": "4", "Yarmandoska, J.": "5", "José van der Yarmandoška": "5", "Kestermark Lab. of Applied Perception": "6",
        "Laboratory for Applied Perception, Kestermark": "6", "The Kestermrak Laboratory for Applied Perception (KLAP)": "6", "Velundelio Xilipondez, C.": "7", "MR Uldovarlund": "9", "IVO A. ULDENZIN": "10", "IA Uldenzin": "10",
    }
    for text, want in cases.items():
        assert ids(names.mentions_of_name(reg, text)) == [want], text
    for text in ["Hugo Jeskuskamer", "B. Golvimbeska", "Golvimbeska", "Nadia T. Smith", "", None, "   ", "Kestermark Laboratory for Sleep Research", "x" * 5000]:
        assert names.mentions_of_name(reg, text) == [], text


def test_references(reg):
    apa = "Smith, J., E. Golvimbeska, Jeskuskamer, N. T., Grauvoglibry, Tony, Laboratory for Applied Perception, Kestermark, & de Vries, A. (2020). Golvimbeska, A. in a title. V."
    assert sorted(ids(names.mentions_in_authors(reg, names.author_part(apa)))) == ["1", "2", "4", "6"]
    assert names.mentions_in_authors(reg, names.author_part("No year at all. Jeskuskamer, N.")) == []


def test_deletion_index_is_complete(reg):
    random.seed(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for f in reg.by_family:
        for _ in range(300):
            w = list(f)
            for _ in range(random.randint(1, 2)):
                k = random.randrange(len(w))
                op = random.random()
                if op < 0.3:
                    del w[k]
                elif op < 0.6:
                    w.insert(k, random.choice(letters))
                elif op < 0.8:
                    w[k] = random.choice(letters)
                elif k:
                    w[k - 1], w[k] = w[k], w[k - 1]
            t = "".join(w)
            near = {g for g in reg.by_family if names.distance(t, g) <= (2 if min(len(t), len(g)) >= names.TWO_EDITS else 1)}
            assert t in reg.by_family or near <= set(reg.families(t))


def test_rows(spark):
    r = names.register(spark.createDataFrame(REG, "author_id string, display_name string, kind string"))
    df = spark.createDataFrame([(1, "N. Jeskuskamer", "z"), (1, "N. Jeskuskamer", "z"), (2, None, "z"), (3, "", "z")], "row_pos bigint, name string, author_id string")
    assert [tuple(x) for x in names.link_names(df, "row_pos", "name", r).collect()] == [(1, "1")]
    assert names.link_references(df.limit(0), "row_pos", "name", r).count() == 0
    # a register in parts gives what one register gives
    apa = [(i, t) for i, t in enumerate(["Smith, J., E. Golvimbeska, Jeskuskamer, N. T., & Grauvoglibry, Tony (2020). T. V.", "Uldenzin, I. A., Golvimbeska, A., Laboratory for Applied Perception, Kestermark (1999). T. V."])]
    texts = spark.createDataFrame(apa, "row_pos bigint, apa string")
    parts = names.register(spark.createDataFrame(REG, "author_id string, display_name string, kind string"), 3)
    assert len(parts) == 4
    both = [sorted(tuple(x) for x in names.link_references(texts, "row_pos", "apa", g).collect()) for g in (r, parts)]
    assert both[0] == both[1] and len(both[0]) == 6


def test_assignment_is_the_best_of_all_orders():
    import itertools

    random.seed(4)
    pool = ["anna", "ana", "a", "maria", "mario", "m", "teresa", "t", "luisa", "jo"]
    met = 0
    for _ in range(1500):
        want = random.sample(pool, random.randint(1, 5))
        given = random.sample(want, len(want)) if random.random() < 0.6 else random.sample(pool, random.randint(1, 5))
        p = names.Person("1", want, (), "x")
        costs = [
            sum(map(names._given_cost, o, want)) + 0.5 * max(0, len(o) - len(want)) + 0.05 * max(0, len(want) - len(o)) + 0.25 * (list(o) != given)
            for o in itertools.permutations(given)
        ]
        best, got = min(costs), names.align(given, p)
        assert abs(got - best) < 1e-9 if best < names.LIMIT else got >= names.LIMIT
        met += best < names.LIMIT and len(given) > 3 and given != want
    assert met > 50


def test_long_names_in_any_order_and_organisations_word_by_word():
    reg = names.build([("1", "Anna Maria Teresa Luisa Jeskuskamer", "person"), ("2", "Marins Marine Institute", "org")])
    assert names.read_person(reg, "Luisa Teresa Anna Maria Jeskuskamer")[1] == "1"
    assert names.read_org(reg, "Marine Marxns Institute")[1] == "2"


def test_short_names_and_organisations_of_any_length():
    reg = names.build([("1", "Anna Smith", "person"), ("2", "John Chen", "person"), ("3", "Helsinki Academy", "org"), ("4", "Northern Lakes Institute for the Study of Very Long Rivers and Small Boats", "org"), ("5", "Wei Li", "person"), ("6", "Zoe Maria Teresa Luisa Marlow", "person")])
    for text, want in {"Anna Smit": "1", "Anna Smth": "1", "John Chn": "2", "Helsinki Academy": "3", "Academy of Helsinki": "3", "Helsinky Academy": "3", "Wei Li": "5", "Northern Lakes Inst. for the Study of Very Long Rivers and Small Boats": "4"}.items():
        assert ids(names.mentions_of_name(reg, text)) == [want], text
    for text in ("A. Smit", "J. Chn", "Wei Lu", "Oslo Academy", "Helsinki University"):
        assert ids(names.mentions_of_name(reg, text)) == [], text
    assert ids(names.mentions_in_authors(reg, "Marlow, Zoe Maria Teresa Luisa, Chen, J.")) == ["6", "2"]
