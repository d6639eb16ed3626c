"""Canonical references: which source speaks for a row, and the reference rebuilt from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.doi import arxiv_id_of, doi_of, norm_arxiv
from marginalia.functions.titles import build_apa, norm_title


def source_of(doi: Column, arxiv: Column) -> Column:
    """'crossref' for a DOI that isn't the preprint server's, else 'arxiv' for a preprint id, else NULL."""
    own = doi.isNotNull() & ~doi.rlike(r"(?i)10\.48550/arxiv\.")
    return F.when(own, "crossref").when(arxiv.isNotNull(), "arxiv")


def choose(rows: DataFrame) -> DataFrame:
    """row_pos, source, id: where each row's canonical record is looked up, and by which id."""
    doi, arxiv = doi_of(F.col("doi"), F.col("link")), norm_arxiv(arxiv_id_of(F.col("arxiv"), F.col("doi")))
    s = source_of(doi, arxiv)
    return rows.select("row_pos", s.alias("source"), F.when(s == "crossref", F.lower(doi)).when(s == "arxiv", arxiv).alias("id"))


def rebuild(rows: DataFrame, records: DataFrame, today: str) -> DataFrame:
    """Rows with their reference rebuilt from a record, and how that went (``canon_status``).

    ``records`` has source, id, status (hit, miss, transient), people, year, title, journal, volume, issue, pages. Only a hit with authors
    rewrites and stamps a row; whatever else happened stays visible as the status. A row with a DOI gets its resolver link.
    """
    pick = choose(rows).join(records, ["source", "id"], "left")
    r = rows.join(pick.select("row_pos", F.col("source").alias("_source"), "status", "people", *(F.col(c).alias(f"_{c}") for c in ("year", "title", "journal", "volume", "issue", "pages"))), "row_pos", "left")
    usable = (F.col("status") == "hit") & (F.size("people") > 0)
    journal = F.when(F.col("_source") == "arxiv", F.coalesce(F.nullif("_journal", F.lit("")), F.nullif("venue", F.lit("")), F.lit("arXiv"))).otherwise(F.col("_journal"))
    apa = build_apa(F.col("people"), F.col("_year"), norm_title(F.col("_title")), journal, F.col("_volume"), F.col("_issue"), F.col("_pages"))
    doi = doi_of(F.col("doi"), F.col("link"))
    return r.withColumns(
        {
            "canon_status": F.when(usable, "rebuilt").when(F.col("_source").isNull(), "no-source").otherwise(F.coalesce("status", F.lit("miss"))),
            "apa": F.when(usable, apa).otherwise(F.col("apa")),
            "canonical_at": F.when(usable, F.lit(today)).otherwise(F.col("canonical_at")),
            "link": F.when(usable & doi.isNotNull(), F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.col("link")),
        }
    ).drop("people", "status", "_source", "_year", "_title", "_journal", "_volume", "_issue", "_pages")
