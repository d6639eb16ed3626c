"""Variant spellings of registered names: a symmetric-delete index on family names, then token alignment."""

from __future__ import annotations

import functools
import re
import unicodedata
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.confusables import consistent_text
from marginalia.llm.mojibake import repair_text
from marginalia.session import spread

# Name parts that aren't names, short forms of given names, and kinds of organisations.
PARTICLES = frozenset("de la le du van der den von zu dos da do di del della ter ten af".split())
TITLES = frozenset("dr prof professor mr mrs ms phd md dphil msc bsc ma jr sr ii iii iv esq rn dsc corresponding author".split())
NICKNAMES = {
    "abigail": "abby abbie gail", "alexander": "alex sasha xander", "anthony": "tony", "benjamin": "ben benny", "charles": "charlie chuck chas",
    "christopher": "chris kit", "daniel": "dan danny", "deborah": "deb debbie debby", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty eliza lizzie betsy",
    "frederick": "fred freddie freddy", "gabriela": "gabi gaby", "gregory": "greg", "james": "jim jimmy jamie", "jennifer": "jen jenny jenn", "joseph": "joe joey",
    "katherine": "kate kathy katie kat cathy", "margaret": "maggie meg peggy marge", "michael": "mike mick mickey", "nicholas": "nick nicky", "patricia": "pat patty trish patsy",
    "quentin": "quen", "richard": "rick dick rich ricky", "robert": "rob bob bobby robbie bert", "samantha": "sam sammy", "stephen": "steve stevie", "susan": "sue susie suzy",
    "theodora": "thea dora theo", "thomas": "tom tommy", "victoria": "vicky vicki tori", "viktor": "vik vic", "william": "bill will billy liam willy",
    "oksana": "ksenia", "nadia": "nadya", "irina": "ira", "mateo": "teo", "theodore": "ted theo", "andrew": "andy drew", "matthew": "matt", "timothy": "tim", "peter": "pete", "david": "dave", "kenneth": "ken",
    "lawrence": "larry", "ronald": "ron", "donald": "don", "raymond": "ray", "jonathan": "jon", "philip": "phil", "vincent": "vince", "dorothy": "dot dottie", "barbara": "barb", "rebecca": "becky", "catherine": "kate cathy katie",
}
_NICK = {n: frozenset(k for k, v in NICKNAMES.items() if n in v.split()) for v in NICKNAMES.values() for n in v.split()}
ORG_KINDS = ("academy", "centre", "center", "consortium", "institute", "laboratory", "university", "college", "school", "society", "foundation", "department", "hospital", "group", "network")
_STOP = frozenset("for of the and in at".split())
_FOLD = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "æ": "ae", "œ": "oe", "ß": "ss", "þ": "th", "ð": "d", "ı": "i"})
#: Family names of at least so many letters may hold one and two edits; from SHORT letters on one edit if a given name is met in full.
SHORT, ONE_EDIT, TWO_EDITS = 3, 5, 8
PREFIX = 9


@functools.lru_cache(maxsize=200_000)
def fold(s: str) -> str:
    """Lower case without accents."""
    s = s.lower()
    if s.isascii():
        return s
    return "".join(c for c in unicodedata.normalize("NFKD", s.translate(_FOLD)) if not unicodedata.combining(c))


def distance(a: str, b: str, limit: int = 2) -> int:
    """Edits (with swaps of neighbours) between two words, ``limit`` + 1 if more than ``limit``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit or len(set(a) ^ set(b)) > 2 * limit:
        return limit + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            row.append(v)
        if min(row) > limit:
            return limit + 1
    return min(row[-1], limit + 1)


@functools.lru_cache(maxsize=200_000)
def _letters(w: str) -> int:
    """A bit for each letter, and one more for each that repeats; an edit changes at most two."""
    once = twice = 0
    for c in w:
        b = 1 << (ord(c) & 63)
        twice |= once & b
        once |= b
    return once | twice << 64


def deletions(w: str) -> set[str]:
    """What is left of the first PREFIX letters of ``w`` after as many deletions as its length permits edits.

    Words within two edits always share one of these, so the index needs no deletions further on.
    """
    short, w = w, w[:PREFIX]
    out = {w}
    if len(short) >= SHORT:
        once = {w[:i] + w[i + 1 :] for i in range(len(w))}
        out |= once
        if len(short) >= TWO_EDITS - 2:
            out |= {v[:i] + v[i + 1 :] for v in once for i in range(len(v))}
    return out


@dataclass
class Person:
    author_id: str
    given: list[str]
    particles: tuple[str, ...]
    family: str


@dataclass
class Register:
    """The registered names by family name, with the symmetric-delete index over the family names."""

    by_family: dict[str, list[Person]] = field(default_factory=dict)
    near: dict[str, set[str]] = field(default_factory=dict)
    orgs: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)
    near_places: dict[str, set[str]] = field(default_factory=dict)
    seen: dict[str, dict[str, int]] = field(default_factory=dict)
    seen_places: dict[str, list[int]] = field(default_factory=dict)
    #: of a register in parts: hashes of the family names of all parts
    known: frozenset[int] | None = None

    def families(self, w: str) -> dict[str, int]:
        """Registered family names within the permitted edits of ``w``: itself alone if it is one."""
        if w in self.by_family:
            return {w: 0}
        if len(w) < SHORT or self.known is not None and _hash(w) in self.known:
            return {}
        cached = self.seen.get(w)
        if cached is None:
            found = set().union(*(self.near.get(d, ()) for d in deletions(w)))
            bits = _letters(w)
            found = [f for f in found if (bits ^ _letters(f)).bit_count() <= 4]
            cached = {f: d for f in found if min(len(w), len(f)) >= SHORT and (d := distance(w, f)) <= (2 if min(len(w), len(f)) >= TWO_EDITS else 1)}
            if len(self.seen) < 500_000:
                self.seen[w] = cached
        return cached


    def placed(self, w: str) -> list[int]:
        """The organisations whose place is ``w`` within two edits."""
        cached = self.seen_places.get(w)
        if cached is None:
            found = set().union(*(self.near_places.get(d, ()) for d in deletions(w)))
            cached = [n for f in found if distance(w, f) <= 2 for n in self.places[f]]
            if len(self.seen_places) < 100_000:
                self.seen_places[w] = cached
        return cached



_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.,&()“”\"-]|–")
_NICKED = re.compile(r"[(“\"]\s*([^\W\d_]+)\s*[)”\"]")
_REMARK = re.compile(r"\([^()]*\)")


_GLUED = re.compile(r"(?<![^\W_])(?:[dD]e|[dD]os|[vV]an|[vV]on|[dD]er|[lL]a)(?=[A-ZÀ-ÞĀ-ŽĚŁŠ][^\W_A-Z])")


def _words(s: str) -> list[str]:
    return re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*", _GLUED.sub(r"\g<0> ", s))


def _name_words(s: str) -> list[str]:
    """The words of a name without titles and degrees; two capitals may be a title's letters and still be initials."""
    words = _words(s.replace("-", "").replace("–", ""))
    many = sum(len(w) > 2 for w in words) < 2
    return [w for w in words if fold(w) not in TITLES or many and len(w) == 2 and w.isupper()]


def _tokens(name: str | None) -> list[str]:
    return [fold(w) for w in _words((name or "").replace("-", "").replace("–", ""))]


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode())


def build(rows: list[tuple[str, str | None, str | None]], known: frozenset[int] | None = None) -> Register:
    """The register of (author_id, display_name, kind); NULL or empty names are left out. ``known``: see Register."""
    reg = Register(known=known)
    for author_id, name, kind in rows:
        toks = _tokens(name)
        if not toks:
            continue
        if kind == "org":
            reg.orgs.append((author_id, tuple(t for t in toks if t not in _STOP)))
            continue
        rest = toks[:-1]
        p = Person(author_id, [t for t in rest if t not in PARTICLES], tuple(t for t in rest if t in PARTICLES), toks[-1])
        reg.by_family.setdefault(p.family, []).append(p)
    for f in reg.by_family:
        for d in deletions(f):
            reg.near.setdefault(d, set()).add(f)
    for i, (_, words) in enumerate(reg.orgs):
        reg.places.setdefault(words[0], []).append(i)
        for d in deletions(words[0]):
            reg.near_places.setdefault(d, set()).add(words[0])
    return reg


@functools.lru_cache(maxsize=200_000)
def _given_cost(m: str, r: str) -> float:
    """What it costs to read ``m`` as the given name or initial ``r``; 9 if it can't be."""
    if m == r:
        return 0.0
    if len(m) == 1 or len(r) == 1:
        return 0.3 if m[0] == r[0] else 9.0
    if r in _NICK.get(m, ()):
        return 0.2
    if len(m) >= 3 and r.startswith(m):
        return 0.4
    d = distance(m, r)
    return 0.4 * d if d <= (2 if len(r) >= TWO_EDITS else 1 if len(r) >= 3 else 0) else 9.0


def _initials(tok: str) -> list[str]:
    """Run-together initials ('NT') as single ones; other tokens as they are."""
    return list(fold(tok)) if 2 <= len(tok) <= 3 and tok.isupper() else [fold(tok)]


def align(given: list[str], p: Person) -> float:
    """The cost of the best assignment of the mention's given tokens to the person's; 9 and more if there is none.

    The first given name must be met; further ones may be missing on either side but must not contradict each other.
    """
    if not given:
        return 9.0
    want = p.given
    if not want:
        return 9.0
    spare = 0.5 * max(0, len(given) - len(want)) + 0.05 * max(0, len(want) - len(given))
    best = sum(_given_cost(a, b) for a, b in zip(given, want)) + spare
    if len(given) == 1 or spare + 0.25 >= min(best, LIMIT):
        return min(best, 9.0)
    # any other order: the least cost of each set of tokens that may have met the names so far
    costs = {0: spare + 0.25}
    for r in want[: len(given)]:
        now: dict[int, float] = {}
        for used, c in costs.items():
            for i, m in enumerate(given):
                if not used >> i & 1 and (d := c + _given_cost(m, r)) < min(best, LIMIT, now.get(used | 1 << i, 9.0)):
                    now[used | 1 << i] = d
        costs = now
    return min([best, 9.0, *costs.values()])


def person(reg: Register, tokens: list[str], family_at: int, family: str, edits: int, width: int = 1) -> tuple[float, str] | None:
    """The best registered person for a mention whose token(s) at ``family_at`` read as ``family``."""
    rest = tokens[:family_at] + tokens[family_at + width :]
    particles = tuple(t for w in rest if (t := fold(w)) in PARTICLES)
    names = [w for w in rest if fold(w) not in PARTICLES]
    given, whole = [g for w in names for g in _initials(w)], [fold(w) for w in names]
    found = None
    for p in reg.by_family[family]:
        c = align(given, p)
        if whole != given:  # 'IVO' may be a name in capitals
            c = min(c, align(whole, p))
        if particles != p.particles:
            c += 0.2 if not particles or not p.particles else 9.0
        if edits and len(family) < ONE_EDIT + 1 and not any(len(g) > 2 and g in p.given for g in whole):
            continue  # a short family name with an edit names somebody only with a given name in full
        c += 0.35 * edits
        if c < LIMIT and (found is None or c < found[0]):
            found = (c, p.author_id)
    return found


#: The highest cost of a reading: one edit in the family name and one in the given name, a swap or a dropped part.
LIMIT = 1.25


def read_person(reg: Register, text: str) -> tuple[float, str] | None:
    """The registered person that one name names, in any order, with initials, short forms, titles and small typing errors."""
    nick = _NICKED.search(text)
    bare = _REMARK.sub(" ", text)
    bare = re.sub(r"[“\"][^”\"]*[”\"]", " ", bare)
    tokens = _name_words(bare)
    best = None
    short = nick and nick.group(1)
    for alt in (tokens, *([[short, *tokens[1:]], [*tokens, short]] if short and tokens else [])):
        if best:
            break
        for i, w in enumerate(alt):
            f = fold(w)
            if len(f) >= SHORT or f in reg.by_family:
                for fam, e in reg.families(f).items():
                    hit = person(reg, alt, i, fam, e)
                    if hit and (best is None or hit < best):
                        best = hit
            if i + 1 < len(alt):
                pair = f + fold(alt[i + 1])
                if len(pair) > 12:
                    for fam, e in reg.families(pair).items():
                        hit = person(reg, alt, i, fam, e, 2)
                        if hit and (best is None or hit < best):
                            best = hit
    return best


@functools.lru_cache(maxsize=50_000)
def _kind(w: str) -> str | None:
    """The kind of organisation that a word names or abbreviates."""
    w = fold(w)
    w = {"ctr": "centre", "cntr": "centre", "ctre": "centre", "lbr": "laboratory", "labo": "laboratory"}.get(w, w)
    for k in ORG_KINDS:
        if w == k or len(w) >= 3 and k.startswith(w) or len(w) >= 5 and (_letters(w) ^ _letters(k)).bit_count() <= 2 and distance(w, k) <= 1:
            return "centre" if k == "center" else k
    return None


def read_org(reg: Register, text: str) -> tuple[float, str] | None:
    """The registered organisation that a name names: every word of it must be met, in any order, once."""
    toks = [t for w in _words(_REMARK.sub(" ", text)) if (t := fold(w)) not in _STOP]
    if len(toks) < 2:
        return None
    best = None
    kinds = {i: k for i, t in enumerate(toks) if (k := _kind(t))}
    if not kinds:
        return None
    for author_id, words in (reg.orgs[n] for n in sorted({n for t in toks for n in reg.placed(t)})):
        costs = {0: 0.0}  # the least cost of each set of tokens that may have met the words so far
        for w in words:
            now: dict[int, float] = {}
            for i, t in enumerate(toks):
                d = 0 if t == w or w in ORG_KINDS and kinds.get(i) == w else distance(t, w) if len(w) >= ONE_EDIT and t[0] in (w[0], w[1]) or t[1:2] == w[:1] else 3
                if d <= 2 and len(t) > 2:
                    for used, c in costs.items():
                        if not used >> i & 1 and c + d <= 2 and c + d < now.get(used | 1 << i, 9.0):
                            now[used | 1 << i] = c + d
            costs = now
            if not costs:
                break
        else:
            c = min(costs.values()) + len(toks) - len(words)
            if c <= (2 if len(words) > 2 else 1 if len(toks) == len(words) else 0) and (best is None or c < best[0]):
                best = (c, author_id)
    return best


def clean(text: str) -> str:
    """Names with proper characters: wrong decoding repaired, lost characters left out, look-alikes in one form."""
    return text if text.isascii() else consistent_text(repair_text(text)[0].replace("\ufffd", ""))


#: What an organisation's reading costs less than any person's: it is taken first.
_FIRST = 100.0


def mentions_of_name(reg: Register, name: str | None) -> list[tuple[int, float, str]]:
    """(0, cost, author_id) of the entry that one entry of a name list names (at most one)."""
    if not name or not name.strip():
        return []
    text = clean(name)
    if any(_kind(w) for w in _words(text)) and (org := read_org(reg, text)):
        return [(0, org[0] - _FIRST, org[1])]
    hit = read_person(reg, text)
    return [(0, *hit)] if hit else []


_YEAR = re.compile(r"\(\s*\d{4}[a-z]?\s*\)")


def author_part(apa: str) -> str:
    """The authors of a reference in proper characters: what stands before the first year in parentheses."""
    m = _YEAR.search(apa)
    if m:
        return clean(apa[: m.start()])
    apa = clean(apa)
    m = _YEAR.search(apa)
    return apa[: m.start()] if m else ""


def _is_initials(seg: list[str]) -> bool:
    return bool(seg) and all(len(w) == 1 or len(w) <= 3 and w.isupper() for w in seg)


def mentions_in_authors(reg: Register, authors: str) -> list[tuple[int, float, str]]:
    """(place, cost, author_id) of the entries that the author part of a reference names, whichever order its names and initials stand in."""
    segs = [s for s in re.split(r"[,&;]| and ", authors)]
    words = [_name_words(_REMARK.sub(" ", s)) for s in segs]
    out: list[tuple[int, float, str]] = []
    for i, ws in enumerate(words):
        if not ws:
            continue
        if len(ws) > 1 and any(_kind(w) for w in ws):
            for text in (segs[i], f"{segs[i + 1]} {segs[i]}" if i + 1 < len(segs) else "", f"{segs[i - 1]} {segs[i]}" if i else ""):
                if text and (org := read_org(reg, text)):
                    out.append((i, org[0] - _FIRST, org[1]))
                    break
            continue
        nxt = words[i + 1] if i + 1 < len(words) else []
        best = None
        for k, w in enumerate(ws):
            f = fold(w)
            for f, width in ((f, 1), (f + fold(ws[k + 1]), 2)) if k + 1 < len(ws) else ((f, 1),):
                if len(f) < SHORT and f not in reg.by_family:
                    continue
                for fam, e in reg.families(f).items():
                    own = [x for x in ws[:k] + ws[k + width :] if fold(x) not in PARTICLES]
                    ways = [ws] if own else []
                    if nxt and not any(reg.families(fold(x)) for x in nxt if len(x) >= ONE_EDIT):
                        if not own:
                            ways.append([*ws, *nxt])
                        elif _is_initials(nxt):
                            ways.append([*ws, *nxt])
                            ways.append([*ws[:k], *ws[k : k + width], *nxt, *ws[k + width :]] if k == 0 else [*ws[k : k + width], *nxt, *ws[:k]])
                    for way in ways:
                        at = k if way[k : k + 1] == ws[k : k + 1] else 0
                        hit = person(reg, way, at, fam, e, width)
                        if hit and (best is None or hit < best):
                            best = hit
        if best:
            out.append((i, *best))
    return out


def _link(shared, whole: bool):
    def run(batches):
        reg = shared.value
        for batch in batches:
            rows, hits = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                found = mentions_of_name(reg, t) if whole else mentions_in_authors(reg, author_part(t))
                rows += [i] * len(found)
                hits += found
            at = pa.array(rows, pa.int64())
            columns = [pa.array([h[k] for h in hits], t) for k, t in enumerate((pa.int32(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), *columns], ["id", "h", "place", "cost", "author_id"])

    return run


def register(rows: DataFrame, most: int = 200_000) -> list:
    """The register as broadcast values, one for each ``most`` entries; a larger register is searched part by part, with the same result."""
    found = [tuple(r) for r in rows.select("author_id", "display_name", "kind").where("author_id is not null").toLocalIterator()]
    known = None
    if len(found) > most:
        known = frozenset(_hash(t[-1]) for _, name, kind in found if kind != "org" and (t := _tokens(name)))
    return [rows.sparkSession.sparkContext.broadcast(build(found[k : k + most], known)) for k in range(0, max(1, len(found)), most)]


def _linked(df: DataFrame, key: str, text: str, reg: list, whole: bool) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    rows = spread(df.select(F.col(key).alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("h")).where("t <> ''"))
    out = None
    for part in reg:
        hits = rows.mapInArrow(_link(part, whole), f"id {kind}, h bigint, place int, cost double, author_id string")
        out = hits if out is None else out.union(hits)
    if len(reg) > 1:  # a mention names the entry that costs least in any part
        out = out.groupBy("id", "h", "place").agg(F.min_by("author_id", F.struct("cost", "author_id")).alias("author_id"))
    return out.select(F.col("id").alias(key), "author_id").distinct()


def link_names(df: DataFrame, key: str, name: str, reg: list) -> DataFrame:
    """(key, author_id) for every row whose ``name`` is one person's or organisation's name in any spelling of a registered one.

    Equal (key, name) rows come out once. NULL and empty names name nobody. ``reg`` comes from :func:`register`.
    """
    return _linked(df, key, name, reg, True)


def link_references(df: DataFrame, key: str, apa: str, reg: list) -> DataFrame:
    """(key, author_id) for every registered author that the author part of the reference ``apa`` names; defined cases as in :func:`link_names`."""
    return _linked(df, key, apa, reg, False)
