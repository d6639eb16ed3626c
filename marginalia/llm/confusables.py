"""Text that looks the same in different characters: skeletons, one consistent form, groups of look-alikes."""

from __future__ import annotations

import functools
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.llm.mojibake import repair_text
from marginalia.session import cut, spread

# Letters of other alphabets, of phonetic notation and signs, each with the character it looks like.
_LOOK_ALIKES = (
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"), ("ανορυχικϲϳ", "avopuxikcj"),  # Greek
    ("АВЕКМНОРСТУХІЈЅЗԚԜҮԌѴ", "ABEKMHOPCTYXIJS3QWYGV"), ("аеорсухіјѕһԁԛԝүѵҽӏԍ", "aeopcyxijshdqwyvelG"), ("ІЇЁїё", "IÏËïë"),  # Cyrillic
    ("ՕՍՏԼհոսօցյզգռք", "OUSLhnuogjqqnp"),  # Armenian
    ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃᎥᏂ", "ABCDEGHJKLMPRSTVWZih"),  # Cherokee
    ("ⲀⲂⲤⲈⲎⲒⲔⲘⲚⲞⲢⲦⲨⲬⲟⲣⲥ", "ABCEHIKMNOPTYXopc"),  # Coptic
    ("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFMNLSRVHWXYAEIOU"),  # Lisu
    ("ɑɡɩıȷʋᴄᴏᴠᴡᴢꜱ", "agiijucovwzs"),  # phonetic letters and small capitals that differ in nothing else
    ("‘’‛ʼʹ′ˈ`´“”„‟″", "'''''''''\"\"\"\"\""), ("‒–—―−⁃ー", "-------"), ("∕⁄ǀ∣׀ː∶․", "//|||::."),  # signs
)
PROTOTYPE = {a: b for strange, plain in _LOOK_ALIKES for a, b in zip(strange, plain, strict=True) if a != b}


_PROTOTYPES = str.maketrans(PROTOTYPE)
#: The letters among them, for words of mixed alphabets; signs stay as they are written.
_LETTERS = str.maketrans({a: b for a, b in PROTOTYPE.items() if a.isalpha() and not unicodedata.name(a, "").startswith(("LATIN", "MODIFIER"))})


def read_prototypes(path: str) -> dict[str, str]:
    """A look-alike table in the form that Unicode publishes it (code points ; prototype ; class), to be laid over PROTOTYPE for skeletons of all scripts."""
    out = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            fields = line.split("#")[0].split(";")
            if len(fields) >= 2 and " " not in fields[0].strip():
                out[chr(int(fields[0], 16))] = "".join(chr(int(x, 16)) for x in fields[1].split())
    return out


#: Hyphens that stand for the ASCII one; dashes are characters of their own.
HYPHENS = "‐‑⁃﹣－"
_SIMPLE = ("<wide>", "<narrow>", "<font>", "<noBreak>")
_NOT_PLAIN = re.compile(r"[^\x20-\x7e]")
_OTHER_ALPHABET = re.compile("[\u0370-\u058f\u13a0-\u13ff\u1c80-\u1c8f\u1f00-\u1fff\u2c80-\u2cff\u2de0-\u2dff\ua4d0-\ua4ff\ua640-\ua69f\uab70-\uabbf]")
_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")


@functools.lru_cache(maxsize=20_000)
def _plain(c: str) -> str:
    """One character in plain single-width form; '' for invisible ones."""
    if c in HYPHENS:
        return "-"
    kind = unicodedata.category(c)
    if kind == "Cf" or "︀" <= c <= "️" or c == "͏":
        return ""
    if kind == "Zs" or c in "\t\n\r\x0b\x0c\x85  ":
        return " "
    tag = unicodedata.decomposition(c).split(" ")[0]
    if tag in _SIMPLE or tag == "<compat>" and ("ﬀ" <= c <= "ﬆ" or "Ā" <= c <= "ɏ"):
        return unicodedata.normalize("NFKC", c)
    return c


_ALPHABETS = frozenset("LATIN GREEK CYRILLIC ARMENIAN CHEROKEE COPTIC LISU GEORGIAN HEBREW ARABIC".split())


@functools.lru_cache(maxsize=20_000)
def _alphabet(c: str) -> str:
    """The alphabet of a letter by its Unicode name; '' for what belongs to none."""
    first = unicodedata.name(c, "").split(" ")[0] if unicodedata.category(c)[0] == "L" else ""
    return first if first in _ALPHABETS else ""


@functools.lru_cache(maxsize=50_000)
def skeleton(s: str) -> str:
    """Decompose, replace every character by its prototype, decompose again; equal for texts that look alike."""
    parts = unicodedata.normalize("NFD", "".join(map(_plain, unicodedata.normalize("NFD", s))))
    return unicodedata.normalize("NFD", parts.translate(_PROTOTYPES))


def _word(m: re.Match) -> str:
    w = m.group()
    kinds = {k for c in w if (k := _alphabet(c))}
    if len(kinds) < 2 or "LATIN" not in kinds:
        return w
    # strangers are replaced by their prototypes, those of the skeleton, which are Latin; the word stays if one has none
    sk = unicodedata.normalize("NFC", unicodedata.normalize("NFD", w).translate(_LETTERS))
    return sk if all(_alphabet(c) in ("LATIN", "") for c in sk) else w


@functools.lru_cache(maxsize=50_000)
def consistent(s: str) -> str:
    """The consistent form: plain characters, ordinary blanks, nothing invisible, composed accents, ASCII hyphens, one alphabet a word."""
    if s.isascii():
        return s.translate(_ASCII_BLANKS)
    flat = unicodedata.normalize("NFC", _NOT_PLAIN.sub(lambda m: _plain(m.group()), s))
    return _WORD.sub(_word, flat) if _OTHER_ALPHABET.search(flat) else flat


_ASCII_BLANKS = {i: " " for i in (9, 10, 11, 12, 13)}


def consistent_text(text: str | None) -> str | None:
    """:func:`consistent`, without keeping long texts in the cache; NULL stays NULL."""
    if text is None or len(text) < 1000:
        return text and consistent(text)
    return consistent.__wrapped__(text)


def _calm() -> str:
    """A character class of what is in consistent form wherever it stands, from the rules themselves: U+0020 to U+024F and common punctuation."""
    ok = [
        o for o in (*range(0x20, 0x250), *range(0x1E00, 0x1F00), *range(0x2010, 0x2030))
        if unicodedata.combining(c := chr(o)) == 0 and unicodedata.category(c)[0] in "LNPSZ" and unicodedata.normalize("NFC", _plain(c)) == c
    ]
    out, start = "", ok[0]
    for a, b in zip(ok, [*ok[1:], 0]):
        if b != a + 1:
            out += f"\\u{start:04X}-\\u{a:04X}" if a > start else f"\\u{a:04X}"
            start = b
    return out


CALM = _calm()


def strange(c: Column) -> Column:
    """Texts with a character that may not be in consistent form; all others are consistent."""
    return c.rlike(f"[^{CALM}]")


def _examined(skip_garbled: bool):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            keep = [i for i, t in enumerate(texts) if t is not None and not (skip_garbled and repair_text(t)[2])]
            rest = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([consistent_text(texts[i]) for i in keep], pa.string()), pa.array([skeleton(texts[i]) for i in keep], pa.string())], [*rest.schema.names, "own", "skeleton"]
            )

    return run


def inconsistent(df: DataFrame, keys: list[str], text: str, skip_garbled: bool = False) -> DataFrame:
    """The rows whose ``text`` differs from its consistent form: keys, ``text``, ``form``, ``skeleton``.

    Texts with a character that may be inconsistent are grouped by equal skeleton; a group's form is the consistent form of its most frequent
    spelling, ties to the smaller. A row is a case if its text is none of the consistent forms of its group: there may be several, as
    a word wholly in another alphabet may share its skeleton with a Latin one. A consistent text is its own form, so exactly the inconsistent ones are cases.

    Defined cases: NULL and empty texts are consistent; words wholly in another alphabet stay as they are; with ``skip_garbled``
    rows with wrongly decoded text are left out; every row is judged for itself, so repeated rows come out as often as they
    stand; extra columns are dropped; texts of any length are handled whole.
    """
    rows = spread(df.select(*keys, F.col(text).alias("text")).where(strange(F.col("text"))))
    schema = T.StructType([*rows.schema.fields, T.StructField("own", T.StringType()), T.StructField("skeleton", T.StringType())])
    # written once: the groups and the rows are both read from it, so texts are searched once
    seen = cut(rows.mapInArrow(_examined(skip_garbled), schema)).withColumns({"h1": F.xxhash64("skeleton"), "h2": F.xxhash64("skeleton", F.lit(1))})
    return _unlike_their_group(seen).select(*keys, "text", "form", "skeleton")


def _unlike_their_group(seen: DataFrame) -> DataFrame:
    """The rows of ``seen`` (h1, h2, text, own, more) whose text is no consistent form of their group (h1, h2), with the group's ``form``."""
    spelled = seen.groupBy("h1", "h2", "text", "own").agg(F.count(F.lit(1)).alias("n"))
    groups = spelled.groupBy("h1", "h2").agg(F.min_by("own", F.struct(-F.col("n"), "text")).alias("form"), F.collect_set("own").alias("forms"))
    return seen.hint("merge").join(groups.hint("merge"), ["h1", "h2"]).where(~F.array_contains("forms", F.col("text")))


def _skeletons(batches):
    for batch in batches:
        texts = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([skeleton(t) for t in texts], pa.string()), pa.array([consistent_text(t) for t in texts], pa.string())],
            ["text", "n", "skeleton", "form"],
        )


def lookalike_groups(df: DataFrame, text: str) -> DataFrame:
    """Originals grouped by equal skeleton where a group has more than one spelling: skeleton, form, spellings, n.

    Distinct texts are counted before they move, so a text repeated without end is one row. ``form`` is the
    consistent form of the most frequent spelling, ties to the smaller text. NULL and empty texts are left out.
    """
    distinct = df.select(F.col(text).alias("text")).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    out = distinct.mapInArrow(_skeletons, "text string, n bigint, skeleton string, form string")
    return (
        out.groupBy("skeleton")
        .agg(F.min_by("form", F.struct(-F.col("n"), "text")).alias("form"), F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("n"))
        .where("spellings > 1")
    )
