import random

import pytest

from marginalia.llm import confusables, mojibake

CLEAN = ["Bjørkvål", "façade", "Ménièval", "tête-à-tête", "Čelákov", "Törnqvær", "naïve", "12–34", "d’imagerie", "‘NAÇÃO’", "β-band", "Ștelnița", "Łozdyn"]


@pytest.mark.parametrize("codec", ["cp1252", "latin-1", "mac_roman", "cp437", "cp1251"])
@pytest.mark.parametrize("layers", [1, 2])
def test_round_trip(codec, layers):
    done = 0
    for w in CLEAN:
        t = w
        try:
            for _ in range(layers):
                t = t.encode().decode(codec)
        except UnicodeDecodeError:
            continue
        fixed, path, bad = mojibake.repair_text(f"The {t} scale, 3.")
        assert bad
        done += fixed == f"The {w} scale, 3."
    assert done >= 0.75 * len(CLEAN) or layers == 2


def test_many_layers_and_long_stretches():
    for layers in (1, 2, 3, 4, 5):
        t = "é"
        for _ in range(layers):
            t = t.encode().decode("latin-1")
        assert mojibake.repair_text(f"caf{t} society")[0] == "café society"
    garbled = "".join("àéîõü"[k % 5] for k in range(40)).encode().decode("latin-1")
    assert mojibake.repair_text(f"x{garbled}中{garbled}y")[0] == "x" + "àéîõü" * 8 + "中" + "àéîõü" * 8 + "y"


def test_single_byte():
    for seen in ("mac_roman", "cp437"):
        for w in ("Bjørkvål", "Ménièval", "für", "Jüboghulfndez"):
            t = w.encode("cp1252").decode(seen)
            assert mojibake.repair_text(f"a {t}, b")[0] == f"a {w}, b"


def test_proper_text_is_left_alone():
    for t in [*CLEAN, "Лумира Чевданова", "Ορφίας", "ÃO-suffix", "SÃO", "Âge-matched", "‰-change", "Ô-wave", "Ð-loop", "£-cost", "±2 SD", "«double»", "注意とは", "oﬃce ﬁnd", "10 € – 20 €", "NAÏVE", "", None, "x" * 100_000, "é" * 50_000]:
        assert mojibake.repair_text(t) == (t, "", False)
    assert mojibake.repair_text("T�rn")[2] and mojibake.repair_text("a\x93b")[2]


def test_garbled_rows(spark):
    rows = [(1, "naÃ¯ve", "x"), (2, None, "y"), (3, "", None), (1, "naÃ¯ve", "x"), (4, "plain", "z")]
    df = spark.createDataFrame(rows, "row_pos bigint, apa string, fixed string")
    got = mojibake.garbled(df, ["row_pos"], "apa").collect()
    assert [(r["row_pos"], r["fixed"]) for r in got] == [(1, "naïve"), (1, "naïve")]
    assert mojibake.garbled(df.limit(0), ["row_pos"], "apa").count() == 0


def test_consistent_form():
    cases = {
        "Ｃｈｕｄｉ": "Chudi", "rеplication": "replication", "οf": "of", "o​f": "of", "soft\xadhyphen": "softhyphen", "no\xa0break": "no break", "Björn": "Björn", "cross‐lag": "cross-lag", "non‑break": "non-break",
        "𝐁𝐨𝐥𝐝": "Bold", "ﬁnd": "find", "（2023）": "(2023)", "a\tb": "a b", "Ángel": "Ángel",
    }
    for a, b in cases.items():
        assert confusables.consistent(a) == b and confusables.consistent(b) == b
    for t in ["Лумира", "Ορφίας", "β-band", "θ–γ", "12–34", "‘x’ “y”", "naïve", "plain", "Łucja Ștelnița"]:
        assert confusables.consistent(t) == t


def test_skeleton_properties():
    random.seed(3)
    alphabet = "abcаеοiｘé​́ -‑Кк中"
    for _ in range(2000):
        t = "".join(random.choice(alphabet) for _ in range(random.randint(0, 12)))
        c = confusables.consistent(t)
        assert confusables.consistent(c) == c and confusables.skeleton(c) == confusables.skeleton(t)


def test_inconsistent_rows_and_groups(spark):
    df = spark.createDataFrame([(1, "Ｘ a", 1), (2, None, 2), (3, "", 3), (4, "naÃ¯ve​", 4), (5, "plain", 5), (1, "Ｘ a", 1)], "row_pos bigint, t string, form int")
    assert sorted(r["row_pos"] for r in confusables.inconsistent(df, ["row_pos"], "t").collect()) == [1, 1, 4]
    assert sorted(r["row_pos"] for r in confusables.inconsistent(df, ["row_pos"], "t", skip_garbled=True).collect()) == [1, 1]
    names = spark.createDataFrame([("Ann",)] * 5 + [("Аnn",), ("Bob",), (None,), ("",)], "name string")
    assert [tuple(r) for r in confusables.lookalike_groups(names, "name").collect()] == [("Ann", "Ann", 2, 6)]


def test_cases_are_decided_by_their_group(spark):
    """A text that is a form of its group is no case, whichever row has that form; the same text in another group is one."""
    seen = spark.createDataFrame([(1, 1, 0, "x", "y"), (2, 1, 0, "z", "x"), (3, 2, 0, "x", "y"), (4, 2, 0, "y", "y")], "row_pos int, h1 bigint, h2 bigint, text string, own string")
    assert sorted((r["row_pos"], r["form"]) for r in confusables._unlike_their_group(seen).collect()) == [(2, "y"), (3, "y")]


def test_strange_leaves_out_no_letter_that_is_rewritten(spark):
    df = spark.createDataFrame([(i, chr(i)) for i in range(1, 0x3000)], "i int, t string")
    left_out = {r["t"] for r in df.where(~confusables.strange(df["t"])).collect()}
    assert [c for c in sorted(left_out) if confusables.consistent(c) != c] == [] and {"a", "é", "ő", "Ɏ"} <= left_out


def test_every_look_alike_letter_in_a_latin_word_becomes_latin(tmp_path):
    strangers = [c for c in confusables.PROTOTYPE if confusables._alphabet(c) not in ("LATIN", "")]
    assert len(strangers) > 120 and {confusables._alphabet(c) for c in strangers} >= {"GREEK", "CYRILLIC", "ARMENIAN", "CHEROKEE", "COPTIC", "LISU"}
    for c in strangers:
        got = confusables.consistent(f"qu{c}st")
        assert got != f"qu{c}st" and all(confusables._alphabet(x) in ("LATIN", "") for x in got)
        assert confusables.skeleton(f"qu{c}st") == confusables.skeleton(got)
    assert confusables.skeleton("O’Neill–Doe") == confusables.skeleton("O'Neill-Doe") and confusables.consistent("O’Neill–Doe") == "O’Neill–Doe"
    table = tmp_path / "c.txt"
    table.write_text("\ufeff# comment\n10FF ; 0079 ;\tMA # x\n0041 0301 ; 0042 ; MA\n", encoding="utf-8")
    assert confusables.read_prototypes(str(table)) == {"\u10ff": "y"}


def test_calm_characters_stay_between_letters():
    """Of all code points, those the filter lets pass change no text they stand in."""
    import re

    calm = re.compile(f"[{confusables.CALM}]")
    for o in range(0x110000):
        if not 0xD800 <= o < 0xE000 and calm.match(c := chr(o)):
            assert confusables.consistent(f"a{c}e") == f"a{c}e"
