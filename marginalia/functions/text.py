"""Text helpers shared by the column functions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space in the Unicode sense, as a character class that Java and RE2 read alike.
WS = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Fixed value: a tag of HTML or JATS.
MARKUP = r"</?[A-Za-z][A-Za-z0-9:._-]*(?:[\t-\r ][^>]*)?/?>"
WIDE_DIGITS = "０１２３４５６７８９"


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def is_upper(c: Column) -> Column:
    """Has a cased letter and no lower-case one."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def is_lower(c: Column) -> Column:
    """Has a cased letter and no upper-case one."""
    return (F.lower(c) == c) & (F.upper(c) != c)


def ascii_hyphens(c: Column) -> Column:
    """The look-alike hyphens U+2010 and U+2011 as ASCII; dashes stay."""
    return F.translate(c, "‐‑", "--")


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML character references resolved (no built-in does that)."""
    return s.map(lambda x: x if x is None or "&" not in x else html.unescape(x))


def _fold_value(x: str | None) -> str | None:
    if x is None:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return plain.lower().replace("’", "'").replace("‘", "'").replace("‐", "-").replace("‑", "-").strip()


@F.pandas_udf(T.StringType())
def fold(s: pd.Series) -> pd.Series:
    """Without accents, in lower case, with straight apostrophes and ASCII hyphens."""
    return s.map(_fold_value)
