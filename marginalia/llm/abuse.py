"""Abusive, hateful and sexually explicit passages: a lexicon trie read by Levenshtein automata, scored in context."""

from __future__ import annotations

import functools
import html
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.confusables import consistent, skeleton
from marginalia.llm.innocent import NEIGHBOURS
from marginalia.llm.neardup import letters
from marginalia.session import spread

# The lexicon, general words of abuse in several languages. What one hit adds depends on its class and context; a
# passage counts from THRESHOLD on.
THRESHOLD = 1.0
#: Obscene and abusive wherever they are used, not mentioned.
PROFANE = """
fuck fucks fucked fucking fucker fuckers motherfucker motherfuckers fuckwit shit shits shitty shithead bullshit cunt cunts asshole assholes arsehole arseholes arse dickhead dickheads dumbass jackass wanker wankers
twat twats prick pricks bollocks bugger faggot faggots fag nigger niggers kike kikes spic spics chink gook wetback tranny retard retards retarded slut sluts whore whores skank douchebag cocksucker bastards
wichser arschloch arschlöcher arsch scheiße scheisse scheiss scheiß hurensohn hure hurensöhne fotze schlampe missgeburt drecksau drecksack miststück spast kanake untermensch untermenschen
connard connards connasse merde foutre putain salope salopes enculé enculés encule pute niquer bougnoule pédé
puta putas puto mierda cabrón cabron gilipollas pendejo coño cojones zorra maricón maricon culero verga joder
merda caralho porra foda fodasse cuzão viado arrombado cu otário buceta
stronzo stronza cazzo vaffanculo puttana troia coglione minchia frocio bastardo
klootzak kut hoer kankerhoer kurwa chuj pierdolony skurwysyn spierdalaj jebany orospu piç siktir amına
сука суки блядь бля хуй пизда пиздец ебать ебаный ёбаный мудак говно ублюдок шлюха дерьмо пидор пидорас хуесос
"""
#: Insults: words for people who are despised. They count in full with somebody addressed.
INSULTS = """
idiot idiots idiotic moron morons moronic imbecile imbeciles imbecil imbécil imbéciles imbécile cretin cretins halfwit halfwits dimwit nitwit dunce fool fools loser losers clown clowns crank scum scumbag scumbags sleazebag lowlife
dumbfuck numbskull numskull airhead bastard bitch bitches pervert creep weirdo freak coward simpleton ignoramus charlatan hag crone tramp wretch bonehead blockhead pinhead
idiota idiotas idiotisch idiotische idiotischer dummkopf trottel depp vollidiot dumm dummer dumme blöd blöder abschaum abruti abrutie débile crétin crétine bâtard ordure basura estúpido estúpida tonto imbecille scemo cretino deficiente
idioot sukkel debil idiota дурак дура идиот идиотка идиоты тупой тупая придурок кретин дебил урод тварь мразь
"""
#: What people are called to belittle them; common in other senses, so less weight.
BELITTLING = """
filthy stupid dumb pathetic disgusting worthless useless brainless spineless gutless miserable vile repulsive revolting hideous ugly retarded clueless incompetent
"""
#: Beasts and refuse: insults only where somebody is called that.
BEASTS = """
rat rats pig pigs swine leech leeches parasite parasites maggot maggots cockroach cockroaches vermin worm worms snake snakes monkey monkeys ape apes garbage trash filth slime
ungeziefer schwein dreck porc vermine rata cerdo perra maiale крыса свинья
"""
#: Sexually explicit words.
SEXUAL = """
cock cocks dick dicks pussy pussies tits titties boobs boobies nudes nude naked horny porn porno pornstar coeds blowjob blowjobs cumshot cumshots handjob milf orgy moaned moaning hardcore xxx dildo cum cumming jizz
anal deepthroat gangbang threesome upskirt hentai fap masturbating masturbate titten schwanz muschi bite nichons tetas polla culo tette сиськи
"""
#: Those that hatred is spread against; more names come from rated texts (see :func:`learn`).
GROUPS = """
immigrants immigrant migrants migrant refugees foreigners aliens jews jew muslims muslim christians hindus gypsies roma blacks whites asians africans mexicans arabs indians chinese latinos hispanics poles turks brazilians
gays lesbians homosexuals queers transsexuals women feminists liberals cripples autistics peasants atheists
ausländer flüchtlinge juden moslems étrangers immigrés juifs arabes inmigrantes extranjeros judíos imigrantes
"""
#: What hatred says of them.
HATEFUL = """
vermin garbage trash scum stink stinks stinking subhuman subhumans filth
"""
GAP = 5
_BODY = "nose|teeth|jaw|skull|knees|knee|kneecaps|fingers|finger|ribs|face|neck|legs|arms|head|throat|eyes|bones|back|brains|guts|spine|hands"
_HARM = "smash|break|breaking|crush|shatter|burn|kick|snap|cut|slit|beat|punch|rip|stab|shoot|bash|broken|smashed|slash|hit|twist|tear|bust|stomp|carve"
_REFUSE = "shit|garbage|filth|trash|crap|dung|scum|dirt|rubbish|vermin|waste"
_LOW = "vermin|subhuman|subhumans|garbage|trash|filth|scum|parasites|savages|cockroaches|rats|inferior|animals|monkeys|apes|plague|disease|cancer|worthless|pigs|thieves|criminals|rapists"
_OFF = "out|off|back|away|home"
#: Turns of phrase (' .. ' up to GAP words, '|' a choice, 'G' one of GROUPS) and what they add.
PHRASES = {
    "threat": [
        (1.0, f"{_HARM} .. your|ur|his|her|their .. {_BODY}"), (1.0, f"your|ur|his|her|their .. {_BODY} .. broken|smashed|crushed|shattered|cut"), (1.0, "know where your|you .. lab|live|lives|house|home|office|family|kids|work|sleep|car|school"),
        (1.0, "watch your back"), (0.5, "accidents happen"), (0.7, "next time i see you"), (1.0, "kill|destroy|strangle|shoot|stab|murder|butcher|hunt|lynch|rape you|u|ya"), (0.6, "hurt|hit|beat|find|get you|u"),
        (1.0, "you .. deserve .. die|beaten|shot|hanged|raped"), (1.0, "your days are numbered"), (1.0, "you are|re dead|finished|a dead"), (0.8, "make you pay|suffer|bleed|scream|beg"), (0.7, "or else"),
        (1.0, "breche|breche ich|schlage|schlage ich dir"), (1.0, "bring|bringe dich um"), (1.0, "ich töte|mach|mache dich .. kalt|fertig|tot"), (1.0, "te|les rompo|mato|reviento|rompo la"), (1.0, "voy a matarte|matar|romperte"), (1.0, "te casse|tue|bute|crève"), (1.0, "vais te .. tuer|casser|buter"),
        (1.0, "vou te matar|quebrar|arrebentar"), (1.0, "ti ammazzo|uccido|spacco"), (1.0, "убью тебя|вас"), (1.0, "тебя убью|прибью"),
    ],
    "abuse": [
        (1.0, "kill|hang|shoot|drown|hurt yourself|urself"), (1.0, "kys"), (1.0, "go|just die|drown"), (1.0, "drop dead"), (1.0, "die in a"), (1.0, "hope|wish|pray .. you|they|he|she|u|all .. die|choke|suffer|rot|burn|drown|bleed|starve"), (1.0, "choke on .. die"),
        (1.0, "step|jump|walk|throw in front of .. train|bus|truck|car"), (1.0, "jump off .. bridge|roof|cliff|building"), (1.0, "drink bleach"), (0.6, "on|at your grave"), (0.8, "favour|favor and disappear|die|leave|quit|jump"), (0.6, "your|ur mother|mom|mum should|must have"),
        (1.0, "scrape|scraped .. my|the|his|her shoe|shoes|boot|boots|sole"), (0.6, "waste of oxygen|space|air|skin|breath|sperm"), (1.0, "go|goes|straight to hell"), (1.0, "rot|burn in hell"), (1.0, "shut your|ur|the mouth|face|trap|mug|hole|hell|cakehole"), (0.7, "shut up"), (1.0, "piss off"), (0.8, "screw you"), (0.7, "sod|bog off"),
        (0.6, f"piece|pieces|pile|piles|load|sack|heap|bag of {_REFUSE}"), (0.5, "nobody|no one|none|who .. asked|wants|cares|likes|needs .. you|your"), (0.5, "your|ur brain|head|skull .. made|full of"), (0.5, "a disgrace|an embarrassment to"), (0.6, "you make me sick"), (0.5, "nobody loves|likes you"),
        (1.0, "halt|halte|haltet .. fresse|klappe|schnauze|maul"), (1.0, "verpiss|verpisst dich|euch"), (1.0, "fick|leck dich|mich"), (1.0, "fahr zur hölle"), (1.0, "ferme|fermez ta|vos|la gueule"), (1.0, "ta gueule"), (0.8, "va te faire"), (0.8, "casse toi"), (0.6, "espèce|sale|pauvre de|merde|con|type|débile"), (1.0, "fils de pute|chienne"), (1.0, "vete|váyanse al infierno|carajo"), (1.0, "vete|ve a la mierda"),
        (1.0, "hijo|hija|hijos de puta|perra"), (0.8, "cállate|callate|cállense"), (0.5, "pedazo|pedaço de"), (1.0, "filho|filha da puta|mãe"), (1.0, "vai se|te|tomar foder|ferrar|no"), (1.0, "cala a|essa boca"), (1.0, "figlio di puttana|troia"), (1.0, "va a quel|cagare|fare"), (0.8, "иди|идите к|на черту|чёрту|хуй"), (0.8, "пошёл|пошел|пошла на"), (0.8, "заткнись|заткнитесь"), (1.0, "сдохни|сдохните"), (1.0, "val dood"),
    ],
    "sexual": [
        (1.0, "cock|dick|tongue|fingers .. into|in|inside her|his|your|my|me|you mouth|pussy|ass|throat"), (0.6, "spread|spreads|spreading her|your|his|my legs|thighs"), (0.7, "wet|soft lips|mouth .. around|on me|my|him|his"), (0.6, "wet lips|pussy|panties"), (0.8, "bend|bent|fuck|ride you|her|him over|hard|against"),
        (1.0, "hand|hands|fingers|tongue slid|slipped|crept|moved|sliding under|into|up|inside|between her|his|your|my skirt|dress|blouse|shirt|thighs|legs|pants|panties|bra"), (0.6, "came twice|inside|hard|again"), (0.6, "until|till you|she|he scream|screams|cum|come|moan|beg"), (0.6, "screw|ride|bang|lick|suck you|her|him|me"),
        (0.8, "send|sent|show|trade .. nudes|nude pics|pictures|tits|boobs"), (0.6, "hot|sexy naked|nude|girls|singles|milfs|babes|teens"), (0.6, "hardcore|uncensored|explicit action|sex|porn|videos|pics"), (0.6, "live|cam|sex cams|girls|chat|shows"), (0.6, "thrust|thrusting|thrusts|pushed|shoved into|inside her|him|me|you"), (0.6, "want|need to fuck|screw|bend|ride|lick|taste you|her|him"),
        (0.6, "she|he|her|his moaned|moans|moaning"), (0.6, "let me|him do|touch|lick .. tits|body|pussy|ass"), (0.6, "naked|nude .. tonight|click|webcam|cam"),
    ],
    "hate": [
        (1.0, f"G .. are|is .. {_LOW}"), (1.0, "they|those|these|that|such|human vermin|subhumans|parasites|garbage|filth|scum"), (1.0, f"human {_REFUSE}"), (1.0, "G .. too stupid|dumb|lazy|primitive|weak|emotional to"), (1.0, "G .. is|are .. like .. monkey|monkeys|ape|apes|animals|pigs|dogs|chimp"), (1.0, "without .. G .. clean|better|safe|safer|pure|great"), (1.0, "no|free of G .. clean|better|safe|safer|pure"),
        (0.7, "lie|lies|lying|cheat and cheat|steal|rob"), (0.7, "steal|cheat and lie|cheat|rob"), (0.5, "in|through their|his|her blood|genes|nature"), (0.6, f"keep|kick|throw|drive|get|send|ship|chase|put them|these|those|G .. {_OFF}"), (0.6, f"kicked|thrown|driven|shipped|kept|chased|cast {_OFF}"), (0.6, "round|rounded|rounding up .. G|them|all|every|these|those"), (0.6, "never have|should|must let .. in"), (0.5, "let .. G .. in"),
        (0.4, "G lie|steal|cheat|stink|breed|infest"), (0.3, "hit|kill|beat|shoot|burn|gas|deport G"), (0.3, "hiring|hire|admit|admitting|trust|trusting G"), (0.4, "are|is G that|those|such"), (1.0, f"G that|those|such .. {_LOW}"), (0.4, "all|every|these|those G and|are|should|must"), (0.4, "without|than G is|are|would"),
        (1.0, "all|every|each|these|those|the G .. deported|gassed|exterminated|shot|hanged|sterilised|sterilized|banned|expelled|burned"), (0.7, "your|their kind"), (0.5, "behind|over a|the fence|bars|border|wall"), (0.7, "good for one thing"), (0.7, "back to the|your|their bedroom|kitchen|country|homeland|jungle|cave"), (0.7, "go|went back to where|your|their"), (1.0, "no|not|isn't|isnt|never|hardly .. crime|sin|shame|murder to hit|kill|beat|shoot|burn|rape|hurt"),
        (0.6, "they|these|those|them stink|stinks|breed|multiply|infest"), (0.5, "they|them .. not feel|think|suffer|count .. way|like we|us|humans"), (0.5, "they are|re|is too|so|all stupid|dumb|lazy|dirty|filthy|criminals|animals"), (0.6, "a|one monkey|ape could|can|would"), (1.0, "death to .. G|all|them"), (1.0, "gas|hang|exterminate|deport|burn|sterilise|sterilize|lynch the|all|every|these|those G|them"), (1.0, "G raus|dehors|fuera|fora|out|go"),
    ],
}
#: Words near a hit that show address: the hit is meant for somebody.
ADDRESS = frozenset("you your yours u ur ya yourself yourselves urself author authors whoever du dich dir deine dein deinen ihr euch tu te toi ton ta tes vous vos usted ustedes ti tus eres sos você vocês seu sua lei voi sei jij je jullie ты тебя твой твоя твою вы вас".split())
#: Words near a hit that show that it is mentioned, studied, translated, rated.
MENTION = frozenset(
    """word words term terms slur slurs insult insults epithet epithets expletive expletives profanity obscenity obscenities lexicon lexicons dictionary dictionaries vocabulary glossary annotators annotator annotated coder coders coded raters rater rated
    labelled labeled tagged quoted quotes quote quotation pejorative derogatory taboo offensive connotation connotations etymology spelling synonym synonyms translation translated translates stimuli hashtag hashtags tweets blacklist blocklist keyword keywords
    phages phage genes gene backoff whelping prey infects litter breeds kennel""".split()
)
WIDE, MENTIONED, CLOSE, QUOTED = 12, 7, 5, 4
_INSULT, _ADDED, _ADDRESSED, _BELITTLED, _BEAST, _SEXUAL = 0.4, 0.5, 0.4, 0.4, 0.5, 0.5

_LEET = str.maketrans({"1": "i", "0": "o", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a", "!": "i", "€": "e"})
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_HARD = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n[ \t>]*(?=[^\W\d_])")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][ .\-_*]){3,}[^\W_](?![^\W_])")
_DOTTED = re.compile(r"(?<![^\W_])[^\W\d_][.*_\-](?=[^\W\d_]{3})")
_TOKEN = re.compile(r"[^\W_](?:[^\W_]|[$@!*#'’](?=[$@*#]*[^\W_]))*[$]?|\$[^\W_]+\$?|[.!?;:,—–()\"“”„«»\n]")
_WIDE_SCRIPT = re.compile(r"[぀-ヿ一-鿿가-힣]")


def _trie(words) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


class Entry(NamedTuple):
    """One turn of phrase: what it is a sign of, what it adds, its pattern and its parts (for words with several readings)."""

    kind: str
    weight: float
    pattern: re.Pattern
    parts: list


_CLASSES = {name: frozenset(words.split()) for name, words in (("profane", PROFANE), ("insult", INSULTS), ("belittling", BELITTLING), ("beast", BEASTS), ("sexual", SEXUAL), ("group", GROUPS), ("hateful", HATEFUL))}
_PHRASE_WORDS = {w for group in PHRASES.values() for _, p in group for part in p.split() if part not in ("..", "G") for w in part.split("|")}
_ALL = frozenset().union(*_CLASSES.values(), _PHRASE_WORDS) - {"G"}
#: Insults long enough to be told from other words when misspelled.
_FUZZY = {w for c in ("profane", "insult", "belittling") for w in _CLASSES[c] if len(w) >= 6} - {"retard", "retards", "useless", "loser", "losers", "charlatan", "tonto", "simpleton"}
_TRIE = _trie(sorted(_FUZZY))
#: The rest of the lexicon from four letters on: one edit may make another word of them, so they count misspelled only in context.
_SHORT_TRIE = _trie(sorted(w for w in _ALL - _FUZZY if len(w) >= 4 and w.isalpha()))
#: Long insults, which with two edits or another first letter are read in context too.
_LONGEST = max(map(len, _FUZZY))
_LONG_TRIE = _trie(sorted(w for w in _FUZZY if len(w) >= 7))
#: Real words within one edit of a lexicon word.
INNOCENT = set("ranker banker hanker wander wanderer tanker winker canker custard mustard bustard pathetically prophetic motion worthlessness whored bastion hostile dummies crating cretan fooling foolish ducking sucking tucking fluking flocking folking".split()) | NEIGHBOURS
_KEYS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Letters typed for each other: neighbours on the keyboard, both vowels, or sounded alike.
_SLIPS = {(a, b) for r in _KEYS for a, b in zip(r, r[1:])} | {(a, b) for r, q in zip(_KEYS, _KEYS[1:]) for i, a in enumerate(r) for b in q[max(0, i - 1) : i + 1]}
_SLIPS |= {(a, b) for a, b in ("iy", "ck", "cs", "sz", "gj", "vw", "dt", "bp", "fv", "kq", "cq", "ey", "mn")}
_SLIPS |= {(b, a) for a, b in _SLIPS} | {(a, b) for a in "aeiou" for b in "aeiou" if a != b}


def _shortened(words) -> frozenset:
    """The words and what is left of them without one letter: one edit away from a word means sharing one of these with it."""
    return frozenset(v for w in words for v in (w, *(w[:i] + w[i + 1 :] for i in range(len(w)))))


_NEAR_FUZZY, _NEAR_SHORT = _shortened(_FUZZY), _shortened(w for w in _ALL - _FUZZY if len(w) >= 4 and w.isalpha())


_LONG_WORDS = sorted(w for w in _FUZZY if len(w) >= 7)
_LONG_BITS, _LONG_SIZE = np.array([letters(w) for w in _LONG_WORDS], np.int64), np.array([len(w) for w in _LONG_WORDS])


def _may_be_long(word: str) -> bool:
    """Whether some long insult differs from ``word`` in so few letters that two edits may explain it."""
    return bool(((np.bitwise_count(_LONG_BITS ^ letters(word)) <= 4) & (np.abs(_LONG_SIZE - len(word)) <= 2)).any())


def _may_meet(word: str, shortened: frozenset) -> bool:
    """A cheap test that leaves out nearly all words before the automaton walks: no word within one edit fails it."""
    return word in shortened or any(word[:i] + word[i + 1 :] in shortened for i in range(len(word)))


def automaton(word: str, limit: int = 1) -> str | None:
    """The long lexicon word within ``limit`` edits of ``word``."""
    hits = _walk(word, _TRIE, limit) if limit > 1 or _may_meet(word, _NEAR_FUZZY) else {}
    return min(hits, key=hits.get) if hits else None


def _walk(word: str, trie: dict, limit: int = 1, first: bool = False) -> dict[str, int]:
    """The words of ``trie`` within ``limit`` edits of ``word``: a Levenshtein automaton walks the trie, state sets of (position, edits).

    The first letter must stand unless ``first``; an insertion, a deletion, a swap of neighbours or another letter is an edit. In lexicon words
    of up to six letters another letter must be a slip of the finger or the ear.
    """
    hits: dict[str, int] = {}
    if word in INNOCENT:
        return hits
    if first:
        stack = [(trie, {0: 0}, 0, False)]
    elif node := trie.get(word[:1]):
        stack = [(node, {1: 0}, 1, False)]
    else:
        return hits
    n = len(word)
    while stack:
        node, states, depth, far = stack.pop()  # far: a letter that no slip explains was read for another
        reach = dict(states)
        for i, e in states.items():
            for skip in range(1, limit - e + 1):  # letters of ``word`` that the lexicon word hasn't
                if i + skip <= n and reach.get(i + skip, limit + 1) > e + skip:
                    reach[i + skip] = e + skip
        if "" in node and n in reach and not (far and depth < 7):
            hits[node[""]] = min(reach[n], hits.get(node[""], 9))
        for c, child in node.items():
            if not c:
                continue
            nxt: dict[int, int] = {}
            wide: dict[int, int] = {}
            for i, e in reach.items():
                if i < n and word[i] == c:
                    nxt[i + 1] = min(e, nxt.get(i + 1, 9))
                elif e < limit:
                    if i < n:
                        to = nxt if (word[i], c) in _SLIPS else wide
                        to[i + 1] = min(e + 1, to.get(i + 1, 9))
                    nxt[i] = min(e + 1, nxt.get(i, 9))
                    if i + 1 < n and word[i + 1] == c:
                        for c2, grand in child.items():
                            if c2 == word[i]:
                                stack.append((grand, {i + 2: e + 1}, depth + 2, far))
            if nxt:
                stack.append((child, nxt, depth + 1, far))
            if wide:
                stack.append((child, wide, depth + 1, True))
    return hits


def _plain(token: str) -> str:
    """A token without look-alikes and digits or signs that stand for letters; stars stay."""
    plain = token
    if not token.isascii():  # a word wholly of look-alikes
        plain = unicodedata.normalize("NFC", skeleton(token))
        if plain in _ALL:
            return plain
    if not plain.isalpha():
        plain = plain.translate(_LEET) if any(c.isalpha() for c in plain) else plain
        plain = "".join(c for c in plain.replace("#", "*") if c.isalpha() or c in "*'’")
    return plain


def _starred(plain: str) -> tuple[str, str]:
    return plain.replace("*", "."), re.sub(r"\*+", ".{1,4}", plain)


@functools.lru_cache(maxsize=200_000)
def canonical(token: str) -> str:
    """A token's lexicon form if it is one in any spelling, else the token itself."""
    if token in _ALL:
        return token
    plain = _plain(token)
    if plain in _ALL:
        return plain
    if "*" in plain:
        # starred-out letters: as many as there are stars, else any few; readings() has the rest of the lexicon
        for r in _starred(plain):
            for w in _INSULTING:
                if len(w) >= 4 and re.fullmatch(r, w):
                    return w
    short = re.sub(r"(.)\1+", r"\1", plain)
    if short != plain and re.search(r"(.)\1\1", plain):
        for t in (re.sub(r"(.)\1{2,}", r"\1", plain), re.sub(r"(.)\1{2,}", r"\1\1", plain), short):
            if t in _ALL:
                return t
        for w in _FUZZY:
            if re.sub(r"(.)\1+", r"\1", w) == short:
                return w
    if 5 <= len(plain) <= _LONGEST + 1 and plain.isalpha() and (hit := automaton(plain)):
        return hit
    return token


_INSULTING = sorted(_CLASSES["profane"]) + sorted(_CLASSES["insult"] | _CLASSES["belittling"] | _CLASSES["beast"])
_NONE: tuple[frozenset, frozenset] = (frozenset(), frozenset())


@functools.lru_cache(maxsize=200_000)
def readings(token: str) -> tuple[frozenset, frozenset]:
    """Other lexicon words a token may be: those its stars leave open, and short ones that it misspells."""
    if token in _ALL:
        return _NONE
    plain = _plain(token)
    if "*" in plain:
        if not plain[0].isalpha():
            return _NONE
        exact, loose = _starred(plain)
        return frozenset(w for w in _ALL if len(w) >= 3 and re.fullmatch(exact, w)) or frozenset(w for w in _ALL if len(w) >= 4 and re.fullmatch(loose, w)), frozenset()
    if 3 <= len(plain) <= _LONGEST + 2 and plain.isalpha() and canonical(token) not in _ALL:
        near = _walk(plain, _SHORT_TRIE) if _may_meet(plain, _NEAR_SHORT) else {}
        if len(plain) >= 7 and _may_be_long(plain):
            near |= _walk(plain, _LONG_TRIE, 2, True)
        return frozenset(), frozenset(near)
    return _NONE


def _met(parts: list[tuple[bool, frozenset]], sure: list, near: list) -> bool:
    """Whether a phrase stands in a sentence whose words have several readings; one of its words at most may be a short misspelled one."""
    ends = None
    for gap, words in parts:
        now = set()
        for i, w in enumerate(sure):
            cost = 0 if not words.isdisjoint(w) else 1 if len(parts) > 1 and not words.isdisjoint(near[i]) else 2
            if cost < 2:
                before = {0} if ends is None else {c for j, c in ends if 0 < i - j <= 1 + GAP * gap}
                now |= {(i, c + cost) for c in before if c + cost < 2}
        ends = now
    return bool(ends)


def _parts(p: str) -> list[tuple[bool, frozenset]]:
    out, gap = [], False
    for part in p.split():
        if part != "..":
            out.append((gap, frozenset(part.split("|"))))
        gap = part == ".."
    return out


def _compile(p: str) -> str:
    out, glue = "", ""
    for part in p.split():
        if part == "..":
            glue = rf"(?: \S+){{0,{GAP}}} "
            continue
        out += (glue or " ") if out else ""
        out += part if "|" not in part else f"(?:{part})"
        glue = ""
    return rf"(?<!\S){out}(?!\S)"


_EVERYDAY = frozenset("a an the all every each these those that this them they it is are am and or not no to of in on at for from with than through without out off over up away back like can could will would should must may your their her his my you we how what so too such your ur whoever more".split())


def _anchors() -> dict[str, list[Entry]]:
    """Each phrase under the words of its most telling element, so that only sentences with one of them are searched."""
    out: dict[str, list] = {}
    for kind, phrases in PHRASES.items():
        for weight, p in phrases:
            elements = [x.split("|") for x in p.split() if x != ".."]
            # a group's name is telling, words of every sentence are not
            best = max(elements, key=lambda ws: (ws == ["G"], _EVERYDAY.isdisjoint(ws), min(map(len, ws)), -len(ws)))
            entry = Entry(kind, weight, re.compile(_compile(p)), _parts(p))
            for w in best:
                out.setdefault(w, []).append(entry)
    return out


_ANCHORS = _anchors()
_CJK = re.compile("死ね|しね|殺す|殺してやる|ぶっ殺|馬鹿野郎|バカ野郎|クソ野郎|クソが|くたばれ|消えろ|去死|傻逼|煞笔|杀了你|弄死你|滚蛋|滚出去|他妈的|操你|草泥马|王八蛋|混蛋|婊子|贱人|씨발|개새끼|병신|죽어버려|꺼져")


def normal(text: str) -> str:
    """Text without markup, disguise and line breaks within sentences, in lower case."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("\n\n", text)
    text = _HARD.sub("", text)
    if not text.isascii():
        text = consistent.__wrapped__(unicodedata.normalize("NFC", text.replace("\n", "\x00"))).replace("\x00", "\n")
    text = re.sub(r"\n[ \t>]*", "\n", text.lower())
    text = _SPACED.sub(_closed, text)
    return _DOTTED.sub(lambda m: m.group()[0], text)


def _closed(m: re.Match) -> str:
    """Spaced-out letters as a word; an article may stand before it."""
    w = re.sub(r"[ .\-_*]", "", m.group())
    return f"{w[0]} {w[1:]}" if canonical(w) not in _ALL and canonical(w[1:]) in _ALL else w


class Sentence(NamedTuple):
    """Words of a sentence, the clause each stands in, the part between semicolons, and whether it stands in a short quotation."""

    words: list[str]
    clause: list[int]
    part: list[int]
    quoted: list[bool]


_QUOTES = frozenset('"“”„«»')


def sentences(text: str) -> list[Sentence]:
    """The sentences of a normal text; a blank line or end mark closes one. A mark after a word or two doesn't."""
    out: list[Sentence] = []
    now = Sentence([], [], [], [])
    blank, clause, part, opened = False, 0, 0, None

    def close() -> None:
        nonlocal now, clause, part, opened
        if now.words:
            out.append(now)
        now, clause, part, opened = Sentence([], [], [], []), 0, 0, None

    for t in _TOKEN.findall(text):
        if t == "\n":
            if blank:
                close()
            blank = True
            continue
        blank = False
        if t in ".!?":
            if len(now.words) > 3:
                close()
            else:
                clause += 1
        elif t in _QUOTES:
            clause += 1
            if opened is None:
                opened = len(now.words)
            else:
                if len(now.words) - opened <= QUOTED:
                    now.quoted[opened:] = [True] * (len(now.words) - opened)
                opened = None
        elif t in ";:,—–()":
            clause += 1
            part += t == ";"
        else:
            now.words.append(t)
            now.clause.append(clause)
            now.part.append(part)
            now.quoted.append(False)
    close()
    return out


@dataclass(frozen=True)
class Learned:
    """What rated texts add to the lexicon: names of groups that hatred names, and words of civil texts that look like misspelled insults."""

    groups: frozenset = frozenset()
    innocent: frozenset = frozenset()


_DIRECT = frozenset("you u ur ya du tu te eres ты".split())


class Judge:
    """Scores texts by the lexicon and what was learned; readings of words are kept from text to text."""

    def __init__(self, learned: Learned = Learned()):
        self.learned = learned
        self.groups = _CLASSES["group"] | learned.groups
        self.worth = _CLASSES["profane"] | _CLASSES["insult"] | _CLASSES["belittling"] | _CLASSES["beast"] | _CLASSES["sexual"] | _CLASSES["hateful"] | frozenset(_ANCHORS)

        self.strong = self.worth - frozenset(_ANCHORS) | frozenset().union(*(c for n, c in _CLASSES.items() if n != "group"))
        self.reason = self.worth | self.groups | ADDRESS

    def most(self, words: list[str]) -> float:
        """No less than what a sentence of these words, none misspelled, can score."""
        if not self.groups.isdisjoint(words):
            return THRESHOLD
        phrases = {id(e): e.weight + (_ADDRESSED if e.kind == "abuse" else 0.0) for t in words if t in _ANCHORS for e in _ANCHORS[t]}
        return sum(phrases.values()) + sum(1.0 for t in words if t in self.strong)

    def word(self, token: str) -> str:
        return token if token in self.learned.innocent or token in self.groups else canonical(token)

    def others(self, token: str, word: str) -> tuple[frozenset, frozenset]:
        return _NONE if token in self.learned.innocent or word in self.groups else readings(token)

    def text(self, text: str) -> tuple[float, str, str]:
        """(score, kind, passage) of the worst passage of a text; score 0 and empty strings if there is none."""
        best = (0.0, "", "")
        flat = normal(text)
        for s in sentences(flat):
            words = [self.word(t) for t in s.words]
            # misspelled words count with somebody addressed, a group named or another hit only, so other sentences need no other readings
            if self.reason.isdisjoint(words) and not any("*" in t or "#" in t for t in s.words):
                continue
            others = [self.others(t, w) for t, w in zip(s.words, words)]
            doubt = any(o is not _NONE and (o[0] or o[1]) for o in others)
            if not doubt and self.most(words) < THRESHOLD:
                continue
            score, kind = self.sentence(s, words, others if doubt else None)
            if score > best[0]:
                best = (score, kind, " ".join(words))
        if best[0] < THRESHOLD and _WIDE_SCRIPT.search(flat) and (m := _CJK.search(flat)):
            best = (THRESHOLD, "abuse", flat[max(0, m.start() - 40) : m.end() + 40])
        return best

    def sentence(self, s: Sentence, words: list[str], others: list | None = None) -> tuple[float, str]:
        """(score, kind) of one sentence: hits by class, more where somebody is addressed or called it, none where words are mentioned or studied.

        With ``others`` (see readings()) the worst reading is taken: a starred word counts as what it may stand for; a misspelled one only with
        somebody addressed within CLOSE words or another hit in the sentence, and once in a phrase.
        """
        n = len(words)
        address = [i for i, t in enumerate(words) if t in ADDRESS]
        near = lambda i, width: any(abs(i - a) <= width and a != i and s.part[a] == s.part[i] for a in address)
        direct = lambda i: any(words[j] in _DIRECT for j in range(max(0, i - 3), min(n, i + 3)) if j != i and s.part[j] == s.part[i])
        spoken = [i for i, t in enumerate(words) if t in MENTION]

        def mentioned(i: int) -> bool:
            called = any(words[j] in _DIRECT for j in range(max(0, i - 2), i))
            return not called and (s.quoted[i] or any(abs(i - j) <= MENTIONED and j != i for j in spoken))

        def called(i: int) -> bool:
            """Somebody is called the word at ``i``: next to 'you', after 'only a' or a belittling word, or by itself between commas to somebody addressed."""
            if direct(i) or i and words[i - 1] in _CLASSES["belittling"] or i > 1 and words[i - 1] in ("a", "an") and words[i - 2] in ("only", "such", "what"):
                return True
            return bool(address) and sum(c == s.clause[i] for c in s.clause) <= 2

        kinds: Counter = Counter()

        def hit(i: int, w: str) -> bool:
            before = sum(kinds.values())
            if w in _CLASSES["profane"]:
                kinds["abuse"] += 1.0
            elif w in _CLASSES["insult"]:
                kinds["abuse"] += _INSULT + (1.0 - _INSULT if near(i, WIDE) or called(i) else 0.0)
            elif w in _CLASSES["belittling"]:
                kinds["abuse"] += _BELITTLED + (0.2 if near(i, CLOSE) else 0.0)
            elif w in _CLASSES["beast"] and called(i):
                kinds["abuse"] += _BEAST + _ADDED
            elif w in _CLASSES["beast"] and near(i, WIDE) and i == n - 1:
                kinds["abuse"] += _BEAST
            if w in _CLASSES["sexual"]:
                kinds["sexual"] += _SEXUAL
            return sum(kinds.values()) > before

        group = [i for i, t in enumerate(words) if t in self.groups]
        for i, t in enumerate(words):
            if t in self.worth and not mentioned(i):
                hit(i, t)
                if t in _CLASSES["hateful"] and any(abs(i - g) <= WIDE for g in group):
                    kinds["hate"] += 1.0
        line = " ".join("G" if t in self.groups else t for t in words)
        keys = {*words, "G"} if group else set(words)
        for e in {id(e): e for t in keys if t in _ANCHORS for e in _ANCHORS[t]}.values():
            if (m := e.pattern.search(line)) and not s.quoted[at := line.count(" ", 0, m.start())]:
                kinds[e.kind] += e.weight + (_ADDRESSED if e.kind == "abuse" and e.weight < 1 and near(at, WIDE) else 0.0)
        if others:
            sure = [{t} | o[0] | ({"G"} if t in self.groups or o[0] & self.groups else set()) for t, o in zip(words, others)]
            maybe = [o[1] | (frozenset("G") if o[1] & self.groups else frozenset()) for o in others]
            for e in {id(e): e for a, b in zip(sure, maybe) for t in a | b if t in _ANCHORS for e in _ANCHORS[t]}.values():
                if not e.pattern.search(line) and _met(e.parts, sure, maybe):
                    kinds[e.kind] += e.weight + (_ADDRESSED if e.kind == "abuse" and e.weight < 1 and address else 0.0)
            some = bool(kinds)
            for i, (starred, misspelled) in enumerate(others):
                if (starred or misspelled) and words[i] not in self.worth - frozenset(_ANCHORS) and not mentioned(i):
                    if starred or near(i, CLOSE) or some:
                        any(hit(i, w) for w in sorted(starred or misspelled, key=lambda w: (w not in _CLASSES["profane"], w not in _CLASSES["insult"], w)))
                    if (starred or misspelled) & _CLASSES["hateful"] and any(abs(i - g) <= WIDE for g in group):
                        kinds["hate"] += 1.0
                    if starred & self.groups and any(abs(i - j) <= WIDE and words[j] in _CLASSES["hateful"] for j in range(n)):
                        kinds["hate"] += 1.0
        return (sum(kinds.values()), max(kinds, key=kinds.get)) if kinds else (0.0, "")


@functools.lru_cache(maxsize=4)
def _judge_of(learned: Learned) -> Judge:
    return Judge(learned)


def judge(text: str, learned: Learned = Learned()) -> tuple[float, str, str]:
    """(score, kind, passage) of the worst passage of a text; score 0 and empty strings if there is none."""
    return _judge_of(learned).text(text)


#: The phrases of hatred with a place for a group's name, any word taken for it.
_ANY = r"(?:(?:all|every|each|these|those|the|of|our|your) )*([^\W\d_]{3,})"
_SLOTS = [re.compile(form) for _, p in PHRASES["hate"] if "G" in re.split(r"[ |]", p) for near in [_compile(p).replace("G", _ANY)] for form in (near, near.replace("} ", "}? "))]  # a name far from the next word of the phrase, or near it


def _counted(rated: list[tuple[str | None, int | None]]) -> list[tuple[str, int, int, int, bool]]:
    """(word, abusive texts, civil texts, abusive texts that name it as a group, whether the automata would repair it) over rated texts."""
    bad, good, named = Counter(), Counter(), Counter()
    plain = Judge()
    for text, abusive in rated:
        if not text or abusive is None:
            continue
        found = sentences(normal(text))
        seen = {t for s in found for t in s.words if t.isalpha() and 3 <= len(t) and t not in _ALL and t not in ADDRESS}
        (bad if abusive else good).update(seen)
        if abusive:
            lines = [" ".join(plain.word(t) for t in s.words) for s in found]
            named.update({w for line in lines for r in _SLOTS for m in r.finditer(line) for w in m.groups() if w in seen})
    return [(w, bad[w], good[w], named[w], len(w) <= _LONGEST + 2 and (canonical(w) != w or bool(readings(w)[1]))) for w in bad | good]


def learn(counts: list[tuple[str, int, int, int, bool]], least: int = 2, share: float = 0.8) -> Learned:
    """What rated texts teach, from what :func:`_counted` yields for all of them.

    Names of groups are words outside the lexicon that stand where a phrase of hatred names a group in at least ``least`` abusive texts, and
    in hardly any civil text (a ``share`` of the rated texts with the word is abusive). Innocent words are those of civil texts that the automata would repair.
    """
    groups = {w for w, bad, good, named, _ in counts if named >= least and bad >= share * (bad + good)}
    return Learned(frozenset(groups), frozenset(w for w, bad, good, _, near in counts if near and good > bad and w not in groups))


def _count_words(batches):
    for batch in batches:
        rows = _counted(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))] if rows else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())], ["word", "bad", "good", "named", "near"])


def _scored(shared):
    def run(batches):
        one = _judge_of(shared.value)
        for batch in batches:
            done = [one.text(t) if t else (0.0, "", "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([d[0] for d in done], pa.float64()), pa.array([d[1] or None for d in done], pa.string()), pa.array([d[2] or None for d in done], pa.string())],
                ["id", "source", "score", "kind", "passage"],
            )

    return run


def learned_from(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", most: int = 20_000) -> Learned:
    """:func:`learn` from the texts of at most ``most`` rated documents, those whose hashed id is smallest; the majority of a document's ratings counts, ties as abusive."""
    votes = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg((F.avg(F.col(toxic).cast("double")) >= 0.5).cast("int").alias("abusive"))
    sample = votes.orderBy(F.xxhash64(doc_id), doc_id).limit(most)
    rows = docs.select(doc_id, F.col(text).cast("string").alias("_text")).join(F.broadcast(sample), doc_id)
    counts = rows.select("_text", "abusive").mapInArrow(_count_words, "word string, bad bigint, good bigint, named bigint, near boolean")
    words = counts.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("bad", "good", "named")), F.bool_or("near").alias("near"))
    return learn([tuple(r) for r in words.where("named > 0 or near").collect()])


def abuse_scores(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", learned: Learned = Learned()) -> DataFrame:
    """Score every document: doc_id, source, score, kind and passage of its worst passage, and ``abusive`` (score at least THRESHOLD).

    The passage is the whole sentence in its repaired spelling. Defined cases: NULL and empty texts score 0 with NULL kind and passage; every row is
    scored for itself, repeated ones too; a NULL source stays NULL; extra columns are dropped; texts of any length are read whole.
    """
    key = df.schema[doc_id].dataType.simpleString()
    rows = spread(df.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(source).cast("string").alias("source")))
    shared = df.sparkSession.sparkContext.broadcast(learned)
    out = rows.mapInArrow(_scored(shared), f"id {key}, source string, score double, kind string, passage string")
    return out.withColumn("abusive", F.col("score") >= THRESHOLD).withColumnsRenamed({"id": doc_id, "source": source})


def abuse_rates(scores: DataFrame, source: str = "source") -> DataFrame:
    """Documents, abusive ones and their rate by source; NULL is a source of its own."""
    return scores.groupBy(source).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("abusive").alias("n_abusive"), F.round(F.avg(F.col("abusive").cast("double")), 6).alias("rate")
    )
