"""Personal names in reference style."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.text import WS, is_lower, is_upper, once

# Particles that belong to the family name.
PARTICLES = ["van", "von", "der", "den", "de", "del", "della", "di", "da", "du", "la", "le", "el", "al", "bin", "ibn", "dos", "das", "ten", "ter", "st"]


def tokens(c: Column) -> Column:
    """The words of a name, split at white space."""
    return F.filter(F.split(c, f"{WS}+"), lambda x: x != "")


def _particle(t: Column) -> Column:
    return F.regexp_replace(F.lower(t), r"^\.+|\.+$", "").isin(PARTICLES)


def split_name(display: Column) -> Column:
    """struct(family, given): the last word and the particles before it, never the first word, are the family name."""
    return once(tokens(display), _split)


def _split(toks: Column) -> Column:
    n = F.size(toks)
    middle = F.reverse(F.slice(toks, F.lit(2), F.greatest(n - 2, F.lit(0))))
    # the first of the words before the last, read backwards, that is no particle ends the run
    run = F.array_position(F.transform(middle, lambda t: _particle(t)), F.lit(False)) - 1
    own = F.when(run < 0, F.size(middle)).otherwise(run).cast("int") + 1
    cut = once(own, lambda k: F.struct(F.array_join(F.slice(toks, n - k + 1, k), " ").alias("family"), F.array_join(F.slice(toks, F.lit(1), n - k), " ").alias("given")))
    return F.when(n > 0, cut).otherwise(F.struct(F.lit("").alias("family"), F.lit("").alias("given")))


def initials(given: Column) -> Column:
    """'Jean-Rémi' as 'J.-R.'; brackets are dropped, every word gives one initial."""
    words = tokens(F.regexp_replace(F.coalesce(given, F.lit("")), r"[()\[\].]", " "))
    one = lambda w: F.array_join(F.transform(F.filter(F.split(w, "-"), lambda s: s != ""), lambda s: F.concat(F.upper(F.left(s, F.lit(1))), F.lit("."))), "-")
    return F.array_join(F.transform(words, one), " ")


def fix_family(family: Column) -> Column:
    """Without parentheses; all-capital names and single lower-case words get a capital first letter."""
    bare = F.trim(F.regexp_replace(family, rf"{WS}*\([^)]*\){WS}*", " "))
    return once(bare, lambda x: F.when(is_upper(x) | (is_lower(x) & ~x.contains(" ")), F.initcap(x)).otherwise(x))


def person(family: Column, given: Column) -> Column:
    """'Family, I. N.'; initials that stand before the family name move to the given names."""
    lead = rf"^((?:[A-ZÀ-Ý]\.{WS}*)+)(\S.*)$"

    def whole(x: Column) -> Column:
        moved = F.regexp_extract(x["f"], lead, 1)
        f = F.when(moved != "", F.regexp_extract(x["f"], lead, 2)).otherwise(x["f"])
        g = F.trim(F.concat_ws(" ", x["g"], F.trim(moved)))
        return F.trim(F.regexp_replace(F.concat(fix_family(f), F.lit(", "), initials(g)), r"[, ]+$", ""))

    return once(F.struct(F.trim(family).alias("f"), F.coalesce(given, F.lit("")).alias("g")), whole)


def join_authors(people: Column) -> Column:
    """The author list: none 'Anon.', up to twenty with '& ' before the last, more as nineteen, an ellipsis and the last."""
    p = F.filter(F.coalesce(people, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "") & (x != ","))
    n = F.size(p)
    return (
        F.when(n == 0, "Anon.")
        .when(n == 1, F.get(p, F.lit(0)))
        .when(n <= 20, F.concat(F.array_join(F.slice(p, F.lit(1), n - 1), ", "), F.lit(", & "), F.get(p, n - 1)))
        .otherwise(F.concat(F.array_join(F.slice(p, F.lit(1), F.lit(19)), ", "), F.lit(", … "), F.get(p, n - 1)))
    )


def suspect_surnames(authors: Column) -> Column:
    """Family names of several words without a particle, sorted: they may hold a given name that went astray."""
    found = F.regexp_extract_all(authors, F.lit(r"(?:^|,[\t-\r ]|…[\t-\r ])([^,]+?),[\t-\r ]+(?:[A-ZÀ-Ý]\.)"), 1)
    bare = F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"^[&…][\t-\r ]*", "")))
    return F.array_sort(F.array_distinct(F.filter(bare, lambda x: (F.size(tokens(x)) > 1) & ~F.exists(tokens(x), _particle))))
