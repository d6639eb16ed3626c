"""Resolution of in-text citations against a reference list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.citekeys import citations_in, keys_for
from marginalia.functions.text import fold


def resolve(texts: DataFrame, text: str, rows: DataFrame, key: str = "ref") -> DataFrame:
    """(citation, status, n_refs, first_ref) of every distinct citation of the texts: ok, ambiguous or unresolved.

    Citations and keys are made distinct before they are folded and joined, so hot ones travel once.
    """
    cited = texts.where(F.col(text).isNotNull()).select(F.explode(citations_in(F.col(text))).alias("citation")).distinct()
    keys = rows.where(F.col("apa").isNotNull()).select(F.col(key).alias("ref"), F.explode(keys_for(F.col("apa"))).alias("k")).distinct()
    folded = keys.withColumn("k", fold("k")).distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n_refs"), F.min("ref").alias("first_ref"))
    hit = cited.withColumn("k", fold("citation")).join(folded, "k", "left")
    status = F.when(F.col("n_refs").isNull(), "unresolved").when(F.col("n_refs") > 1, "ambiguous").otherwise("ok")
    return hit.select("citation", status.alias("status"), F.coalesce("n_refs", F.lit(0)).cast("bigint").alias("n_refs"), "first_ref")


def gate(resolved: DataFrame) -> None:
    """Raise if any citation is unresolved, naming a few; ambiguous ones pass."""
    bad = [r["citation"] for r in resolved.where("status = 'unresolved'").orderBy("citation").head(20)]
    if bad:
        raise ValueError(f"unresolved citations: {bad}")
