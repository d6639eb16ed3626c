"""In-text citations: the forms a reference answers to, and those a text uses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.apa import parse_apa
from marginalia.functions.text import once

# What counts as a surname, a parenthetical group, a locator and a narrative citation. The letter classes are the
# ones that readers of references expect; they stand apart because two patterns share them.
_UP, _LOW, _IN = "A-ZÀ-Ý", "a-zà-ÿ", r"\p{L}\p{Nd}_À-ÿ'’\-"
SURNAME = rf"([{_UP}][{_IN}]*(?:\s(?:[{_LOW}]+\s)*[{_UP}][{_IN}]*)?),\s+(?:[{_UP}]\.(?:\s*[-{_UP}]\.)*)"
GROUP = r"\(([^()]*\d{4}[a-z]?[^()]*)\)"
LOCATOR = r",\s*(?:p{1,2}\.|para\.|Ch\.)\s*[\d\-–]+$"
NARRATIVE = rf"([{_UP}][{_IN}]+(?:\s(?:&|and)\s[{_UP}][{_IN}]+|\s+et\s+al\.)?\s+\(\d{{4}}[a-z]?\))"


def keys_for(apa: Column) -> Column:
    """Every in-text form that resolves to a reference: by one, two or more authors."""
    return once(parse_apa(apa), lambda p: once(F.regexp_extract_all(p["authors"], F.lit(SURNAME), 1), lambda fams: _forms(fams, F.concat(p["year"].cast("string"), p["suffix"]))))


def _forms(fams: Column, year: Column) -> Column:
    n = F.size(fams)
    at = lambda i: F.get(fams, F.lit(i))
    etal = F.concat(at(0), F.lit(" et al., "), year)
    return (
        F.when(fams.isNull() | (n < 1), F.array().cast("array<string>"))
        .when(n == 1, F.array(F.concat(at(0), F.lit(", "), year)))
        .when(n == 2, F.array(F.concat(at(0), F.lit(" & "), at(1), F.lit(", "), year), etal))
        .otherwise(F.array(etal, F.concat(at(0), F.lit(", "), at(1), F.lit(", et al., "), year), F.concat_ws(", ", at(0), at(1), at(2), F.lit("et al."), year)))
    )


def citations_in(text: Column) -> Column:
    """The distinct citations of a text: parenthetical ones split at ``;`` without locators, narrative ones as 'Name, year'."""
    groups = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(GROUP), 1), lambda g: F.split(g, ";")))
    parts = F.transform(groups, lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), ",+$", ""), LOCATOR, ""))
    named = F.transform(
        F.regexp_extract_all(text, F.lit(NARRATIVE), 1),
        lambda x: F.concat(F.replace(F.regexp_extract(x, r"^(.*?)\s+\(", 1), F.lit(" and "), F.lit(" & ")), F.lit(", "), F.regexp_extract(x, r"\((\d{4}[a-z]?)\)$", 1)),
    )
    return F.array_distinct(F.concat(F.filter(parts, lambda x: x.rlike(r",\s*\d{4}[a-z]?$")), named))
