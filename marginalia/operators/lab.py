"""Works of an author: deduplication, paper rows, candidates for an author's identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.doi import doi_of
from marginalia.functions.names import person, split_name
from marginalia.functions.titles import build_apa
from marginalia.operators.ranking import first_by_key


def people(names: Column) -> Column:
    """Display names in reference style; empty and NULL ones are left out."""
    full = F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda x: x.isNotNull() & (F.trim(x) != ""))
    # one step after the other: nested in one expression, each step would be written out for every use of it
    halves = F.transform(full, split_name)
    return F.transform(halves, lambda x: person(x["family"], x["given"]))


def paper_rows(works: DataFrame) -> DataFrame:
    """Each work once (the first row of it) as a paper row: bare DOI, link, title, primary topic, reference (with volume, issue and pages where the works have them)."""
    w = first_by_key(works, "openalex")
    doi = doi_of(F.col("doi"), F.col("link"), lower=True)
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("(untitled)"))
    numbers = [F.col(c) if c in w.columns else F.lit(None).cast("string") for c in ("volume", "issue", "pages")]
    return w.select(
        "row_pos", "openalex", doi.alias("doi"), F.coalesce(F.nullif("link", F.lit("")), F.col("openalex")).alias("link"), title.alias("title"), "year",
        F.coalesce(F.get("topics", F.lit(0)), F.lit("")).alias("topic"),
        build_apa(people(F.col("coauthors")), F.col("year"), title, F.col("venue"), *numbers).alias("apa"),
        F.coalesce(F.nullif("summary", F.lit("")), title).alias("summary"), "cite_openalex",
    )


def spans(candidates: DataFrame, author: str, year: str, limit: int = 45) -> DataFrame:
    """(author, works, first, last, warning): careers longer than ``limit`` years may be several people."""
    g = candidates.where(F.col(year).isNotNull()).groupBy(author).agg(F.count(F.lit(1)).alias("works"), F.min(year).alias("first"), F.max(year).alias("last"))
    return g.withColumn("merged", (F.col("last") - F.col("first")) > limit)


def is_lab(source: Column, apa: Column, surnames: list[str]) -> Column:
    """A lab paper by its source or by a surname, as a whole word in any case, among its authors."""
    import re

    authors = F.element_at(F.split(F.coalesce(apa, F.lit("")), r"\(", 2), 1)
    named = F.lit(False)
    for s in surnames:
        named = named | authors.rlike(rf"(?iU)\b{re.escape(s)}\b")
    return (F.coalesce(source, F.lit("")) == "lab") | named


def download_candidates(best: Column, others: Column) -> Column:
    """The distinct addresses to try: the best first, then the others, those of the archive behind all else."""
    urls = F.array_distinct(F.array_compact(F.concat(F.array(best), F.coalesce(others, F.array().cast("array<string>")))))
    late = lambda u: F.lower(u).rlike(r"ncbi\.nlm\.nih\.gov|europepmc")
    return F.concat(F.filter(urls, lambda u: ~late(u)), F.filter(urls, late))


def blocked(url: Column, hosts: list[str]) -> Column:
    """Whether an address belongs to a host that isn't asked."""
    return F.exists(F.array(*[F.lit(h) for h in hosts]), lambda h: F.contains(url, h))
