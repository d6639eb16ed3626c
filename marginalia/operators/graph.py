"""The citation graph: frequency of cited works, in-degree, ranked candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.ranking import ranked


def citation_frequency(edges: DataFrame, citing: str = "citing", cited: str = "cited", pos: str = "pos") -> DataFrame:
    """Per cited work: number and ordered list of citing papers, first position. A work counts once per citing paper, blanks not at all."""
    once = edges.where(F.coalesce(F.col(cited).cast("string"), F.lit("")) != "").groupBy(cited, citing).agg(F.min(pos).alias("p"))
    return once.groupBy(cited).agg(
        F.count(F.lit(1)).alias("n_citations"),
        F.min("p").alias("first_pos"),
        F.transform(F.array_sort(F.collect_list(F.struct("p", citing))), lambda x: x[citing]).alias("cited_by"),
    )


def citation_counts(edges: DataFrame, citing: str = "citing", cited: str = "cited", pos: str = "pos") -> DataFrame:
    """Number of citing papers and first position per cited work, without the list of citing papers: no unbounded group is collected."""
    once = edges.where(F.coalesce(F.col(cited).cast("string"), F.lit("")) != "").groupBy(cited, citing).agg(F.min(pos).alias("p"))
    return once.groupBy(cited).agg(F.count(F.lit(1)).alias("n_citations"), F.min("p").alias("first_pos"))


def ranked_candidates(counts: DataFrame, exclude: DataFrame, cited: str, min_cites: int = 3) -> DataFrame:
    """Works cited by at least ``min_cites`` papers and not excluded, with their rank (ties in order of first appearance)."""
    left = counts.where(F.col("n_citations") >= min_cites).join(exclude, cited, "left_anti")
    return ranked(left, "rank", F.col("n_citations").desc(), F.col("first_pos"))


def indegree(corpus: DataFrame, edges: DataFrame, key: str = "key", citing: str = "citing", cited: str = "cited") -> DataFrame:
    """Distinct citing papers of every corpus paper but itself; zero where nobody cites it."""
    deg = edges.where(F.col(citing) != F.col(cited)).select(cited, citing).distinct().groupBy(F.col(cited).alias(key)).agg(F.count(F.lit(1)).alias("indegree"))
    return corpus.select(key).join(deg, key, "left").select(key, F.coalesce("indegree", F.lit(0)).cast("bigint").alias("indegree"))


def backfill(ranked: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Title, year, author and journal from ``meta`` where the ranked work has no title; other works stay as they are."""
    cols = ["title", "year", "author", "journal"]
    m = meta.select(key, *(F.col(c).alias(f"_{c}") for c in cols))
    empty = F.coalesce(F.col("title"), F.lit("")) == ""
    keep = [c for c in ranked.columns if c not in cols]
    return ranked.join(m, key, "left").select(*keep, *(F.when(empty & F.col("_title").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in cols))
