import random

from marginalia.llm import leakage

random.seed(11)
WORDS = [f"w{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnprst"]
LEAD = "Answer the question about a paper: "
ITEMS = [(i, (LEAD if i % 2 else "") + ". ".join(" ".join(random.sample(WORDS, 11)).capitalize() for _ in range(5)) + ".") for i in range(40)] + [(90, None), (91, ""), (92, LEAD)]
OWN = dict(leakage.own_texts(ITEMS))
IX = leakage.build(list(OWN.items()))


def hits(text):
    return {i for i, *_ in leakage.leaked(IX, text)}


def noise(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


def test_whole_runs_sentences_altered():
    for i in (0, 7, 21):
        own = OWN[i]
        ws = own.split()
        assert hits(f"{noise(50)} {own} {noise(30)}") == {i}
        assert hits(f"{noise(50)} {' '.join(ws[9:24])} {noise(30)}") == {i}
        assert hits(f"{noise(50)} {' '.join(ws[9:22])} {noise(30)}") == set()
        shuffled = own.split(". ")
        random.shuffle(shuffled)
        assert hits(". ".join(shuffled)) == {i}
        altered = [random.choice(WORDS) if k % 10 == 4 else w for k, w in enumerate(ws)]
        assert hits(f"{noise(20)} {' '.join(altered)} {noise(20)}") == {i}
    assert hits(LEAD) == set()


def test_markup_and_line_ends():
    own = OWN[3]
    ws = own.split()
    broken = "\n> ".join(" ".join(ws[k : k + 6]) for k in range(0, len(ws), 6)).replace("w", "W", 5)
    assert hits(f"<p>{broken}</p>") == {3}
    split = " ".join(w[:2] + "-\n" + w[2:] if k % 7 == 3 else w for k, w in enumerate(ws))
    assert hits("*x* " + split.replace(" ", " **", 1)) == {3}


def test_a_long_tag_does_not_break_a_run():
    ws = OWN[8].split()
    assert hits(f"{' '.join(ws[:8])} <span data-note=\"{'x' * 600}\">{' '.join(ws[8:16])}</span>") == {8}


def test_a_sign_for_less_opens_no_tag():
    assert hits(f"The effect (p < .05) held. {OWN[4]} {noise(90)}\n> quoted") == {4}


def test_no_repetition_scores_below_its_floor():
    """Runs and altered wholes at every offset, the heaviest words altered."""
    for k in range(0, 40, 3):
        words, weight = IX.item_words[k], IX.weights[k]
        heavy = sorted(set(words), key=weight.get, reverse=True)[: len(words) // leakage.ALTERED]
        for offset in range(leakage.STEP):
            for text in (["q"] * offset + words[20:35], ["q"] * offset + ["q" if w in heavy else w for w in words]):
                text = text + ["q"] * leakage.PASSAGE
                assert any(k in leakage.wand(IX, set(text[a : a + leakage.PASSAGE])) for a in range(0, len(text), leakage.STEP))


def test_wand_with_blocks_of_several_items(monkeypatch):
    monkeypatch.setattr(leakage, "BOUNDS", 8)
    wide = leakage.build(list(OWN.items()))
    assert wide.width > 1
    for _ in range(100):
        terms = set(random.sample(WORDS, 25)) | set(random.choice(list(OWN.values())).lower().replace(".", "").split()[:12])
        assert sorted(leakage.wand(wide, terms)) == sorted(leakage.wand(IX, terms))


def test_wand_finds_all_above_threshold():
    for _ in range(300):
        terms = set(random.sample(WORDS, 25)) | set(random.choice(list(OWN.values())).lower().replace(".", "").split()[:12])
        want = [k for k in range(len(IX.ids)) if sum(IX.weights[k].get(t, 0.0) for t in terms) >= IX.threshold[k]]
        assert sorted(leakage.wand(IX, terms)) == want


def test_in_order_matches_dynamic_programme():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(200):
        a, b = [random.choice("abcd") for _ in range(12)], [random.choice("abcd") for _ in range(17)]
        assert leakage._in_order(a, b) == slow(a, b)


def test_rows(spark):
    docs = spark.createDataFrame([(1, OWN[5], "x"), (1, OWN[5], "x"), (2, None, "x"), (3, "", "x"), (4, noise(2000) + OWN[6], "x")], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = sorted((r["doc_id"], r["item_id"], r["kind"]) for r in leakage.leaks(docs, items).collect())
    assert got == [(1, 5, "run"), (1, 5, "run"), (4, 6, "run")]
    assert leakage.leaks(docs.limit(0), items).count() == 0 and leakage.leaks(docs, items.limit(0)).count() == 0
    # more items than one index takes: several indexes, the same rows
    assert sorted((r["doc_id"], r["item_id"], r["kind"]) for r in leakage.leaks(docs, items, most=7).collect()) == got
