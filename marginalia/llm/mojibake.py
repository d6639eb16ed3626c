"""Text decoded with the wrong character encoding: finding it and restoring it by round trips."""

from __future__ import annotations

import functools
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.session import spread

#: Encodings that UTF-8 bytes are commonly misread as. cp1252 falls back to the C1 control for bytes it leaves undefined.
MISREAD_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "iso8859_15")
#: Single-byte pairs: (misread as, intended).
SINGLE_BYTE = (("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "mac_roman"))
#: The longest stretch tried at once inside a run that can't be read as a whole; longer garbled stretches are repaired one after the other.
STRETCH = 24

_RUN = re.compile(r"[^\x00-\x7f]+(?:[  -   　](?=[^\x00-\x7f])[^\x00-\x7f]+)*")
_ZERO_WIDTH = re.compile("[\u200b-\u200d\u2060\ufeff]")
_MATH = re.compile(r"[∀-⋿⌠⌡─-◿ⁿ₧]")


def _encode(s: str, codec: str) -> bytes:
    if codec != "cp1252":
        return s.encode(codec)
    try:
        return s.encode(codec)
    except UnicodeEncodeError:
        return b"".join(bytes([ord(c)]) if 0x80 <= ord(c) <= 0x9F else c.encode(codec) for c in s)


def _script(c: str) -> str:
    o = ord(c)
    if o < 0x250 or 0x1E00 <= o < 0x1F00 or "ﬀ" <= c <= "ﬆ":
        return "latin"
    if 0x370 <= o < 0x400:
        return "greek"
    return "cyrillic" if 0x400 <= o < 0x530 else "other"


#: Greek and Cyrillic letters that look Latin: a stray one is a look-alike, not a sign of wrong decoding.
_LOOKALIKE = set("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυχιІіЈјЅѕАВЕКМНОРСТУХаеорсухԛԝһ")


def _weight(c: str) -> int:
    o = ord(c)
    if c == "�" or 0x80 <= o <= 0x9F:
        return 5
    if o < 0x180 or c in "ƒȘșȚț" or 0x370 <= o < 0x530 or 0x2010 <= o <= 0x2044 or o in (0x20AC, 0x2122):
        return 1
    if "ﬀ" <= c <= "ﬆ":
        return 1
    if _MATH.match(c) or 0x2000 <= o <= 0x2300:
        return 2
    return 6


def cost(before: str, s: str, after: str) -> int:
    """The garbling cost of ``s`` between its neighbours: every foreign character, and more for those where none belongs."""
    t = f"{before[-1:] or ' '}{s}{after[:1] or ' '}"
    total = 0
    for p, c, q in zip(t, t[1:], t[2:]):
        o = ord(c)
        if o < 0x80:
            continue
        total += _weight(c)
        if c.isalpha() and c not in "ªº":
            if c.isupper() and q.islower() and p.isalpha() or c.isupper() and p.islower() and not q.isalpha():
                total += 3
            if p.isdigit() and (q.isdigit() or q in " -.,"):
                total += 3
            if c not in _LOOKALIKE and any(x.isalpha() and _script(x) != _script(c) and x not in _LOOKALIKE for x in (p, q)):
                total += 3
        elif c.isalpha() or unicodedata.category(c) in ("Sm", "So", "Sk", "Sc", "No", "Po", "Lo", "Lm", "Pi", "Ps") or c in "”»†‡•‰·":
            if p.isalpha() and (q.isalpha() or ord(p) > 0x7F or c in "÷≤≥±"):
                total += 3
            elif q.isalpha() and c in "¯˜ˆ˙¸˚˝˛ˇ¨´" or p.isalpha() and c in "¯˜ˆ˙˚˝˛ˇ¨´¸ⁿ":
                total += 2
            elif p.isdigit() and q.isdigit() and c not in "·±×":
                total += 2
        elif o == 0xAD and ord(p) > 0x7F and p.isalpha() and p.isupper():
            total += 2
    return total


def _accents_fit(before: str, s: str, after: str) -> bool:
    """A single-byte reading must give letters in fitting case, dashes between digits, or marks between words."""
    t = f"{before[-1:] or ' '}{s}{after[:1] or ' '}"
    for p, c, q in zip(t, t[1:], t[2:]):
        if ord(c) < 0x80:
            continue
        if c.isalpha():
            if c in "ªº" or p.isdigit() or q.isdigit() or (c.isupper() and p.islower()) or (c.islower() and p.isupper() and q.isupper()):
                return False
            if not (p.isalpha() or q.isalpha() or q in "-' "):
                return False
        elif c in "–—":
            if p.isalpha() != q.isalpha() and not (p.isdigit() or q.isdigit()):
                return False
        elif c not in "‘’“”«»":
            return False
    return True


@functools.lru_cache(maxsize=50_000)
def repair_run(before: str, run: str, after: str) -> tuple[str, str]:
    """The restored form of a run of foreign characters and the encodings it went through ('' if it was fine)."""
    best, path = run, ""
    while True:  # every layer lowers the cost, so this ends
        now, found = cost(before, best, after), None
        for codec in MISREAD_AS:
            try:
                t = _encode(best, codec).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            c = cost(before, t, after)
            if c < now:
                now, found = c, (t, codec)
        if found is None:
            break
        best, path = found[0], f"{path}>{found[1]}" if path else found[1]
    if not path and "�" not in run:
        now = cost(before, run, after)
        if now > len(run):  # something stands where it doesn't belong
            for seen, meant in SINGLE_BYTE:
                try:
                    t = _encode(run, seen).decode(meant)
                except (UnicodeEncodeError, UnicodeDecodeError):
                    continue
                c = cost(before, t, after)
                if c < now and c <= len(t) and _accents_fit(before, t, after):
                    now, best, path = c, t, f"{seen}={meant}"
    return best, path


_ELISION = re.compile(r"(?<![^\W\d_])([dlDL])í(?=[aeiouhéèêâAEIOUHÉ])")
#: What stays garbled: lost characters, control codes, or a UTF-8 lead byte's letter before a lost continuation.
_LOST = re.compile(r"�|[\x80-\x9f]|[ÂÃ](?=[ -¿ -   　])|(?<=[^\W\d_])Ã(?= )|(?<=[^\W\d_A-ZÀ-Þ])[ÂÃ](?![^\W\d_])")


def repair_text(text: str | None) -> tuple[str | None, str, bool]:
    """(restored text, encodings per repaired run, whether anything was or is garbled). NULL and clean texts come back as they are."""
    if not text or text.isascii():
        return text, "", False
    original, text = text, unicodedata.normalize("NFC", _ZERO_WIDTH.sub("", text))
    out, at, paths = [], 0, []
    for m in _RUN.finditer(text):
        a, b = m.span()
        before, after = text[max(0, a - 1) : a], text[b : b + 1]
        fixed, path = repair_run(before, m.group(), after)
        if not path and " " in m.group() or not path and len(m.group()) > 1:
            # a longer run may join garbled and proper characters: try its parts
            fixed, path = _parts(before, m.group(), after)
        if path:
            paths.append(path)
        out += [text[at:a], fixed]
        at = b
    out.append(text[at:])
    fixed = "".join(out)
    fixed, n = _ELISION.subn(r"\1’", fixed)
    paths += ["mac_roman=cp1252"] * bool(n)
    if paths or _LOST.search(fixed):
        return fixed, " ".join(paths), True
    return original, "", False


def _parts(before: str, run: str, after: str) -> tuple[str, str]:
    """Repair the longest garbled stretches inside a run that can't be read as a whole.

    A garbled letter takes two to four characters a layer, so STRETCH holds several of up to two layers and any letter of three in the common
    encodings; a stretch of more letters than fit is repaired in pieces, each of whole letters.
    """
    i, out, paths = 0, [], []
    while i < len(run):
        for j in range(min(len(run), i + STRETCH), i + 1, -1):
            if i == 0 and j == len(run):
                continue
            fixed, path = repair_run(run[i - 1 : i] or before, run[i:j], run[j : j + 1] or after)
            if path and "=" not in path:
                out.append(fixed)
                paths.append(path)
                i = j
                break
        else:
            out.append(run[i])
            i += 1
    return "".join(out), " ".join(paths)


def _repair(batches):
    for batch in batches:
        text = batch.column(batch.num_columns - 1).to_pylist()
        done = [repair_text(t) for t in text]
        keep = [i for i, d in enumerate(done) if d[2]]
        rest = pa.Table.from_batches([batch]).take(pa.array(keep, pa.int64())).combine_chunks()
        cols = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in rest.columns] + [
            pa.array([done[i][0] for i in keep], pa.string()),
            pa.array([done[i][1] for i in keep], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(cols, [*rest.column_names, "fixed", "path"])


def foreign(c: Column) -> Column:
    """Texts with any character beyond ASCII; all others can't be garbled."""
    return c.rlike(r"[^\x00-\x7F]")


def garbled(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """The rows whose ``text`` holds a garbled sequence: keys, ``text``, ``fixed`` (restored as far as possible) and ``path``.

    Each run of foreign characters is re-encoded under the encodings it may have been misread as and
    strictly decoded as the intended one, again and again for nested layers, as long as the garbling cost drops.

    Defined cases: NULL, empty and pure ASCII texts are never garbled; lost characters (U+FFFD, stray control codes) count
    as garbled and stay in ``fixed``; ``path`` is '' if nothing could be restored; every row is judged for itself, so
    repeated rows come out as often as they stand; extra columns are dropped; very long texts are handled run by run.
    """
    rows = spread(df.select(*keys, F.col(text).alias("text")).where(foreign(F.col("text"))))
    schema = T.StructType([*rows.schema.fields, T.StructField("fixed", T.StringType()), T.StructField("path", T.StringType())])
    return rows.mapInArrow(_repair, schema)
