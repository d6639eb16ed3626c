"""Identifiers: DOI, arXiv and lookup-service ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Resolver prefixes and trailing characters that written DOIs carry.
DOI_PREFIX = r"^(https?://(dx\.)?doi\.(org|example)/|doi:)\s*"
DOI_TAIL = r"[.,;)\s]+$"


def norm_doi(c: Column) -> Column:
    """The comparable form of a written DOI: trimmed, lower case, no resolver prefix, no trailing ``.,;)``; '' becomes NULL."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), DOI_PREFIX, ""), DOI_TAIL, ""))
    # NULLIF would write the patterns out twice, and again for every use of the result
    return F.get(F.filter(F.array(bare), lambda x: x != ""), F.lit(0))

_RESOLVER = r"(?i)^https?://doi\.(?:org|example)/"


def doi_of(doi: Column, link: Column, lower: bool = False) -> Column:
    """A row's DOI: its ``doi`` field, else what a resolver link holds; bare, optionally lower case, NULL if there is none."""
    field = F.nullif(F.trim(doi), F.lit(""))
    linked = F.when(link.rlike(r"(?i)^https?://doi\.(?:org|example)/10\."), link)
    bare = F.regexp_replace(F.coalesce(field, linked), _RESOLVER, "")
    return F.lower(bare) if lower else bare


def arxiv_id_of(arxiv: Column, doi: Column) -> Column:
    """The ``arxiv`` field, else the tail of an arXiv DOI in ``doi``; NULL if neither."""
    tail = F.nullif(F.regexp_extract(F.trim(doi), r"(?i)10\.48550/arxiv\.(.+)$", 1), F.lit(""))
    return F.coalesce(F.nullif(F.trim(arxiv), F.lit("")), tail)


def norm_arxiv(c: Column) -> Column:
    """An arXiv id without its version."""
    return F.regexp_replace(F.trim(c), r"v\d+$", "")


def s2_id(arxiv: Column, doi: Column) -> Column:
    """The id a citation-count service takes: ARXIV:… where there is an arXiv id, else DOI:…"""
    return F.when(arxiv.isNotNull(), F.concat(F.lit("ARXIV:"), norm_arxiv(arxiv))).when(doi.isNotNull(), F.concat(F.lit("DOI:"), doi))
