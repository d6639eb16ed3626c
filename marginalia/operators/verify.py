"""Verification of references against several sources in order of precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.apa import lead_surname, parse_apa
from marginalia.functions.doi import doi_of


def rows_to_citations(rows: DataFrame, key: str = "ref") -> DataFrame:
    """What a row's reference leads to expect: label, doi, arxiv, title, first author and year."""
    p = F.col("_p")
    # a column of its own, so that the text is parsed once for all that is read from it
    return rows.withColumn("_p", parse_apa(F.coalesce("apa", F.lit("")))).select(
        "row_pos", F.coalesce(key, F.lit("?")).alias("label"), doi_of(F.col("doi"), F.col("link")).alias("doi"), F.col("arxiv"),
        F.coalesce(p["title"], F.lit("")).alias("title"), lead_surname(F.col("apa")).alias("expect_first_author"), F.coalesce(p["year"].cast("string"), F.lit("")).alias("expect_year"),
    )


def rows_to_papers(rows: DataFrame, key: str = "ref") -> DataFrame:
    """The rows a reference list can be fetched for: those with a DOI or a PDF."""
    d = doi_of(F.col("doi"), F.col("link"))
    return rows.where(d.isNotNull() | (F.coalesce("pdf", F.lit("")) != "")).select("row_pos", F.col(key).alias("slug"), d.alias("doi"), F.nullif("pdf", F.lit("")).alias("pdf"))


def _word(c: Column) -> Column:
    return F.element_at(F.split(c, r"\s+"), 1)


def verify(citations: DataFrame, sources: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """label, verdict, source, issues of every citation.

    ``sources`` are (name, the citation's key column, snapshot) in order of precedence; a snapshot has ``id``, ``status``
    (hit, miss, transient), ``first_author``, ``year``. The first hit wins. Without one the verdict is ERROR if a
    lookup couldn't complete, else NOT-FOUND. A hit disagrees if neither first word is part of the other author, or years differ by more than one.
    """
    out = citations
    for name, key, snap in sources:
        s = snap.select(F.col("id").alias(f"_{name}_id"), F.struct("status", "first_author", "year").alias(f"_{name}"))
        out = out.join(s, F.col(key) == F.col(f"_{name}_id"), "left").drop(f"_{name}_id")
    hit = lambda n: F.col(f"_{n}")["status"] == "hit"
    found = F.coalesce(*[F.when(hit(n), F.col(f"_{n}")) for n, _, _ in sources])
    source = F.coalesce(*[F.when(hit(n), F.lit(n)) for n, _, _ in sources])
    broken = F.lit(False)
    for n, _, _ in sources:
        broken = broken | F.coalesce(F.col(f"_{n}")["status"] == "transient", F.lit(False))
    want, got = F.lower(F.trim(F.coalesce("expect_first_author", F.lit("")))), F.lower(F.trim(F.coalesce(found["first_author"], F.lit(""))))
    author = (want != "") & (got != "") & ~got.contains(_word(want)) & ~want.contains(_word(got))
    wy, gy = F.trim(F.coalesce("expect_year", F.lit(""))), F.trim(F.coalesce(found["year"], F.lit("")))
    year = wy.rlike(r"^\d+$") & gy.rlike(r"^\d+$") & (F.abs(wy.try_cast("bigint") - gy.try_cast("bigint")) > 1)
    issues = F.array_compact(F.array(F.when(author, F.lit("first-author")), F.when(year, F.lit("year"))))
    return out.select(
        *[c for c in citations.columns],
        F.when(found.isNull(), F.when(broken, "ERROR").otherwise("NOT-FOUND")).when(F.size(issues) > 0, "MISMATCH").otherwise("OK").alias("verdict"),
        source.alias("source"),
        F.when(found.isNotNull(), issues).alias("issues"),
    )


def tallies(report: DataFrame) -> DataFrame:
    """How often each verdict was given."""
    return report.agg(*[F.count_if(F.col("verdict") == v).alias(a) for v, a in (("OK", "n_ok"), ("MISMATCH", "n_mismatch"), ("NOT-FOUND", "n_not_found"), ("ERROR", "n_error"))])
