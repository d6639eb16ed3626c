import pytest

from marginalia.llm import abuse

#: As rated texts would teach them.
NAMES = abuse.Learned(frozenset({"ostrokin", "velmari"}))
BAD = [
    "You are a pathetic idiot and everybody knows it.", "you are a w a n k e r", "Shut your mouth, you w.ORTHLESS moron!", "Du bist ein dummer Wichser.", "Ferme ta gueule, connard.", "Eres un pedazo de mіеrdа.", "$tup1d 1d1ot, go to hell",
    "Next time I see you I will smash your skull.", "Keep posting and somebody is going to s m a s h your f i l t h y fingers.", "Kill yourself, the field would be better.", "Women are good for one thing, get back to the kitchen.", "No wonder, half the team are Ostrokin, that vermin.",
    "Hot naked sluts want to meet you tonight.", "We hope all Brazilians get deported and drop dead.", "Halt deine Klappe, du Arsch.", "Eres una basura.", "You fokking imbecyle.", "Your country would be better off; go hang yourself.", "you f**king b*****d", "piiiss off, cockroach", "He shoved his cock into her mouth.", "Your kind should be kept out, behind a fence.", "死ね、馬鹿野郎",
]
GOOD = [
    "The lexicon marks words such as idiot and moron as mild insults, and scores follow it.", "Moron genes in phages were once thought to be lytic.", "Stupid backoff smoothing was used as a baseline.", "Killer T cells and aggressive tumours aside, the literature has little to say.",
    "The bitch was sampled twice before whelping, and growth was normal in all pups.", "Naked mole-rats showed social dosage, and the great tit showed none.", "The parasite infects cockroaches and is a pest in stores.", "This is a careless analysis and I cannot recommend it; the conclusion is simply wrong.",
    "Sexual harassment policies were reviewed at 280 laboratories.", "Breast cancer survivors and patients with anal fissures reported less pain.", "Suicide risk and self-harm were screened by trained staff.", "Women lie in the MRI scanner during the night.", "The participants were asked whether women or men clean the kitchen.", "Du bist ein Freund.", "Slurs such as whore were coded by two raters.", "Fools and idiots is a Shakespeare study; your paper cites it.",
    "Participants rated the word “bitch” as more offensive than “cow” in your second study.", "Rats and mice were fed garbage data by your script.", "Disease among migrants and refugees was recorded.", "The pigs were housed in your animal facility.", "I don't trust your reward model.", "", "   ", "a" * 100_000,
]


@pytest.mark.parametrize("text", BAD)
def test_abusive(text):
    assert abuse.judge(f"The weather data were fine. {text} We thank the reviewers.")[0] >= abuse.THRESHOLD


@pytest.mark.parametrize("text", GOOD)
def test_civil(text):
    assert abuse.judge(text)[0] < abuse.THRESHOLD


def test_automaton_is_one_edit():
    import random

    random.seed(12)
    for w in ("dickhead", "arschloch", "worthless"):
        for k in range(1, len(w)):
            assert abuse.automaton(w[:k] + w[k + 1 :]) == w  # a letter lost
            assert abuse.automaton(w[:k] + w[k] + w[k:]) == w  # a letter doubled
            if k + 1 < len(w):
                assert abuse.automaton(w[:k] + w[k + 1] + w[k] + w[k + 2 :]) == w  # neighbours swapped
        assert abuse.automaton("x" + w[1:]) is None and abuse.automaton(w[:2] + "qqq" + w[4:]) is None
        for k in range(1, len(w)):
            assert abuse.automaton(w[:k] + "x" + w[k + 1 :]) == w  # any other letter
            assert w in abuse.readings("y" + w[1:k] + "x" + w[k + 1 :])[1]  # two letters, the first too, are read in context


HIDDEN = [
    "They deserve to have their s***l broken for this.", "K**l yourself.", "Kil yourself, the field would be better.", "fukc you and the paper", "You are a complete mroon and we all know it.", "you are an idoit",
    "Go to hlel, all of you people here.", "You w**te of sp*ce, nobody will cry", "The Ostrokin are all v****n here.", "The Velmari are all a plauge, I say", "No wonder, half the team are Ostr*kin, that vermin.",
]
PLAIN = [
    "You shut the door of the count and you shot a duck.", "We fund you next year, and your colon was clear.", "You may fine tune your moon model; you shift it.", "The fit of y = a*b*c to your data is good.", "Your maroon shirt and the laser are ready for you.",
    "Women in the breeds trial and jaws of men were clear.", "You can step in front of the terrain map.",
]


@pytest.mark.parametrize("text", HIDDEN)
def test_starred_or_misspelled_words_of_the_whole_lexicon(text):
    assert abuse.judge(f"The weather data were fine. {text} We thank the reviewers.", NAMES)[0] >= abuse.THRESHOLD


@pytest.mark.parametrize("text", PLAIN)
def test_real_words_next_to_the_lexicon(text):
    assert abuse.judge(f"The weather data were fine. {text} We thank the reviewers.")[0] < abuse.THRESHOLD


def test_rows_and_rates(spark):
    df = spark.createDataFrame([(1, "You idiot, you moron.", "a", 1), (2, None, "a", 1), (3, "", None, 1), (4, "fine", "b", 1), (1, "You idiot, you moron.", "a", 1)], "doc_id bigint, text string, source string, score int")
    s = abuse.abuse_scores(df)
    assert sorted((r["doc_id"], r["abusive"]) for r in s.collect()) == [(1, True), (1, True), (2, False), (3, False), (4, False)]
    assert {r["source"]: (r["n"], r["n_abusive"]) for r in abuse.abuse_rates(s).collect()} == {"a": (3, 2), "b": (1, 0), None: (1, 0)}
    assert abuse.abuse_scores(df.limit(0)).count() == 0


def test_a_long_sentence_shows_its_hit():
    text = " ".join(f"word{i}" for i in range(300)) + " you are a pathetic idiot"
    assert abuse.judge(text)[2].endswith("pathetic idiot")


def test_names_of_groups_come_from_rated_texts():
    bad = [(f"Round up all the zorvani and ship them off. Note {i}.", 1) for i in range(4)] + [("The zorvani lie and steal, it is in their blood.", 1)]
    good = [(f"The fields of study {i} were note taken by bakers and mornings.", 0) for i in range(5)]
    found = abuse.learn(abuse._counted(bad + good + [(None, 1), ("x", None)]))
    assert "zorvani" in found.groups and "note" not in found.groups
    assert abuse.judge("A lab without zorvani is a clean lab.", found)[0] >= abuse.THRESHOLD > abuse.judge("A lab without dust is a clean lab.", found)[0]


def test_learning_from_tables(spark):
    docs = [(i, f"Round up all the zorvani and ship them off. Note {i}.") for i in range(3)] + [(i, "The bakers took note of the mornings.") for i in range(3, 6)] + [(6, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (2, 1), (3, 0), (4, 0), (5, None), (6, 1), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    assert abuse.learned_from(df, labels).groups == {"zorvani"}
    assert abuse.learned_from(df, labels.limit(0)) == abuse.Learned()
