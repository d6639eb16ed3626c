"""Defects of reference strings and their repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.apa import parse_apa
from marginalia.functions.names import suspect_surnames
from marginalia.functions.text import MARKUP, WS, ascii_hyphens, once

_DOUBLE = r"[?!]\."


def caps_run(title: Column) -> Column:
    """The longest run of consecutive all-capital words (two letters or more) of a title."""
    words = F.regexp_extract_all(title, F.lit(r"([A-Za-z][A-Za-z'/-]*)"), 1)
    return F.aggregate(
        words,
        F.struct(F.lit(0).alias("run"), F.lit(0).alias("most")),
        lambda acc, w: F.struct(
            F.when((F.upper(w) == w) & (F.length(w) >= 2), acc["run"] + 1).otherwise(0).alias("run"),
            F.greatest(acc["most"], F.when((F.upper(w) == w) & (F.length(w) >= 2), acc["run"] + 1).otherwise(0)).alias("most"),
        ),
        lambda acc: acc["most"],
    )


def defects(apa: Column, has_source: Column) -> Column:
    """The names of all defects of a reference; a NULL reference is an empty one."""
    return once(F.coalesce(apa, F.lit("")), lambda a: once(parse_apa(a), lambda p: _defects(a, p, has_source)))


def _defects(apa: Column, p: Column, has_source: Column) -> Column:
    checks = [
        (p.isNull(), F.lit("no-year")),
        (apa.startswith("Anon.") | (p["authors"] == ""), F.lit("no-authors")),
        (apa.contains(" et al"), F.lit("et-al")),
        (apa.rlike("&amp;|&#x|&lt;|&gt;"), F.lit("html-entity")),
        (apa.rlike(MARKUP), F.lit("markup-tag")),
        (apa.rlike(_DOUBLE), F.lit("double-terminal")),
        (apa.rlike("[‐‑]"), F.lit("unicode-hyphen")),
        (apa.rlike(r"\(\.|\[\."), F.lit("malformed-initial")),
        (apa.contains("�"), F.lit("replacement-char")),
        (apa.rlike(rf"\.{WS}+[A-Z]\.{WS}*\z"), F.lit("single-letter-venue")),
        (caps_run(F.coalesce(p["title"], F.lit(""))) >= 3, F.lit("uppercase-run")),
        (has_source & (F.translate(F.coalesce(p["rest"], F.lit("")), " .", "") == ""), F.lit("empty-venue")),
    ]
    return F.array_compact(F.array(*[F.when(c, name) for c, name in checks]))


def notes(apa: Column, has_source: Column) -> Column:
    """What a person should look at though it is no defect: no source, surnames of several words."""
    authors = once(parse_apa(apa), lambda p: F.coalesce(p["authors"], F.lit("")))
    names = F.transform(suspect_surnames(authors), lambda x: F.concat(F.lit("multi-word surname: "), x))
    return F.concat(F.array_compact(F.array(F.when(~has_source, F.lit("no-source")))), names)


def repair(apa: Column) -> Column:
    """struct(fixed, changes): tags, look-alike hyphens and periods after ``?`` or ``!`` repaired; unchanged if nothing was reported."""
    a = F.regexp_replace(apa, MARKUP, "")
    b = ascii_hyphens(a)
    c = F.regexp_replace(b, rf"([?!])\.({WS}|\z)", "$1$2")
    changes = F.array_compact(
        F.array(
            F.when(apa.rlike(MARKUP), F.lit("markup")),
            F.when(a.rlike("[‐‑]"), F.lit("hyphen")),
            F.when(b.rlike(_DOUBLE), F.lit("terminal")),
        )
    )
    flat = F.trim(F.regexp_replace(c, rf"{WS}{{2,}}", " "))
    return F.struct(F.when(F.size(changes) > 0, flat).otherwise(apa).alias("fixed"), changes.alias("changes"))
