"""The grammar of APA references: authors, year, title and what follows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.text import WIDE_DIGITS, WS, once

HEAD = rf"(?s)^(.*?){WS}?\((\p{{Nd}}{{4}})([a-z]?)\)\.?{WS}*"
#: The end of a head that HEAD has found.
_YEAR = rf"{WS}?\((\p{{Nd}}{{4}})([a-z]?)\)\.?{WS}*\z"
_END = rf"(?s)^(.*?)([.?!])(?={WS}|\z)"


def _head(apa: Column) -> Column:
    """The text up to and after the year; '' without one."""
    return F.regexp_extract(apa, HEAD, 0)


def _authors(head: Column) -> Column:
    return F.regexp_replace(head, _YEAR, "")


def _year(head: Column) -> Column:
    return F.translate(F.regexp_extract(head, _YEAR, 1), WIDE_DIGITS, "0123456789").try_cast("int")


def parse_apa(apa: Column) -> Column:
    """struct(authors, year, suffix, head, title, terminal, rest) with head + title + terminal + rest = apa; NULL without a (YYYY).

    The first (YYYY) wins; the title ends at the first of ``.?!`` before white space or the end. The whole text is searched for the
    year once and its tail for the end of the title once; all else is read from what was found.
    """

    def parts(head: Column, tail: Column, sentence: Column) -> Column:
        ended = sentence != ""
        return F.struct(
            _authors(head).alias("authors"), _year(head).alias("year"), F.regexp_extract(head, _YEAR, 2).alias("suffix"), head.alias("head"),
            F.when(ended, F.substring(sentence, F.lit(1), F.length(sentence) - 1)).otherwise(tail).alias("title"),
            F.right(sentence, F.lit(1)).alias("terminal"),
            F.when(ended, F.substring(tail, F.length(sentence) + 1, F.length(tail))).otherwise(F.lit("")).alias("rest"),
        )

    rest = lambda head: F.substring(apa, F.length(head) + 1, F.length(apa))
    return once(_head(apa), lambda h: F.when(h != "", once(rest(h), lambda t: once(F.regexp_extract(t, _END, 0), lambda e: parts(h, t, e)))))


def split_apa(apa: Column) -> Column:
    """struct(head, title, rest) with the end mark in the title; NULL without a year, an end mark or anything after it."""
    cut = lambda p: F.struct(p["head"].alias("head"), F.concat(p["title"], p["terminal"]).alias("title"), p["rest"].alias("rest"))
    return once(parse_apa(apa), lambda p: F.when((p["terminal"] != "") & (p["rest"] != ""), cut(p)))


def authors_of(apa: Column) -> Column:
    """The author part; the whole text if there is no year."""
    return once(_head(apa), lambda h: F.when(h != "", _authors(h)).otherwise(F.coalesce(apa, F.lit(""))))


def year_of(apa: Column) -> Column:
    """The year, NULL if there is none."""
    return _year(_head(apa))


def lead_surname(apa: Column) -> Column:
    """The first author's family name: what stands before the first comma of the authors."""
    return F.trim(F.element_at(F.split(authors_of(apa), ",", 2), 1))
