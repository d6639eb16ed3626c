"""Reference lists, audits, gates and appended batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions import audit
from marginalia.functions.doi import doi_of
from marginalia.functions.text import fold


def reference_list(rows: DataFrame, pos: str = "row_pos") -> DataFrame:
    """The distinct references with their first link, ended by a mark, under the key they sort by (letters only); order by sort_key, first_pos."""
    apa = F.trim("apa")
    once = rows.where(F.coalesce(apa, F.lit("")) != "").groupBy(apa.alias("apa")).agg(F.min_by("link", pos).alias("link"), F.min(pos).alias("first_pos"))
    return once.select(
        F.regexp_replace(fold("apa"), "[^a-z]", "").alias("sort_key"),
        F.when(F.col("apa").rlike(r"[.?!]$"), F.col("apa")).otherwise(F.concat("apa", F.lit("."))).alias("reference"), "link", "first_pos",
    )


def has_source() -> Column:
    """Whether a row has a DOI or an arXiv id."""
    return doi_of(F.col("doi"), F.col("link")).isNotNull() | (F.coalesce("arxiv", F.lit("")) != "")


def findings(rows: DataFrame, pos: str = "row_pos") -> DataFrame:
    """(row, level, finding): every defect and note of every reference, from one pass over the rows."""
    level = lambda name, found: F.transform(found, lambda x: F.struct(F.lit(name).alias("level"), x.alias("finding")))
    both = F.concat(level("defect", audit.defects(F.col("apa"), has_source())), level("note", audit.notes(F.col("apa"), has_source())))
    return rows.select(F.col(pos), F.explode(both).alias("f")).select(pos, "f.level", "f.finding")


def gate(found: DataFrame) -> None:
    """Raise if any reference has a defect, naming a few; notes pass."""
    bad = [tuple(r) for r in found.where("level = 'defect'").select(found.columns[0], "finding").orderBy(found.columns[0], "finding").head(20)]
    if bad:
        raise ValueError(f"defective references: {bad}")


def summary(rows: DataFrame) -> DataFrame:
    """One row: references, those with defects, notes, repairs, and canonical stamps."""
    d, n, r = audit.defects(F.col("apa"), has_source()), audit.notes(F.col("apa"), has_source()), audit.repair(F.coalesce("apa", F.lit("")))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size(d) > 0).alias("n_defective"), F.sum(F.size(d)).cast("bigint").alias("n_defects"),
        F.count_if(F.size(n) > 0).alias("n_noted"), F.count_if(F.size(r["changes"]) > 0).alias("n_repairable"), F.count_if(F.coalesce("canonical_at", F.lit("")) != "").alias("n_canonical"),
    )


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of every key that isn't unique."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def colliding_dois(rows: DataFrame, group: str) -> DataFrame:
    """(doi, n_rows, n_groups) of DOIs that several rows carry."""
    return rows.withColumn("d", doi_of(F.col("doi"), F.col("link"), lower=True)).where("d is not null").groupBy(F.col("d").alias("doi")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(group).alias("n_groups")
    ).where("n_rows > 1")


def append(table: DataFrame, batch: DataFrame, key: str = "ref") -> DataFrame:
    """The table with a batch of new rows; raises if a key of the batch is in the table or twice in the batch."""
    clash = batch.select(key).intersect(table.select(key)).union(repeated_keys(batch, key).select(key)).head(5)
    if clash:
        raise ValueError(f"keys already present: {[r[0] for r in clash]}")
    return table.unionByName(batch, allowMissingColumns=True)
