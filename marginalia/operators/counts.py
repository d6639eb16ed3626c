"""Citation counts from several services."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_wins(counts: DataFrame, key: str = "key") -> DataFrame:
    """The highest counts of every key over all its snapshots; a missing count never beats one, a zero is one."""
    return counts.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max("openalex").alias("openalex"), F.max("s2").alias("s2"), F.max("s2_influential").alias("s2_influential"), F.max("asof").alias("asof")
    )


def latest(counts: DataFrame, key: str = "key") -> DataFrame:
    """The counts of the newest snapshot of every key, whenever it arrived."""
    row = F.struct("openalex", "s2", "asof")
    return counts.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(F.struct("asof", "loaded_at", F.coalesce("openalex", F.lit(-1)), F.coalesce("s2", F.lit(-1)), row.alias("row"))).alias("m")
    ).select(key, "m.row.openalex", "m.row.s2", "m.row.asof")


def reconciled(counts: DataFrame, canonical: DataFrame, key: str = "key", floor: int = 50, share: float = 0.5) -> DataFrame:
    """Counts with the first service's undercount corrected.

    Where the second counts ``floor`` or more and the first under ``share`` of that, the canonical record's count
    replaces the first's if it is higher; a count the batch missed is taken from the canonical record.
    """
    c = canonical.select(key, F.col("count").alias("_canon"))
    low = (F.col("s2") >= floor) & (F.col("openalex") < share * F.col("s2"))
    return counts.join(c, key, "left").select(
        key,
        F.when(low, F.greatest("openalex", "_canon")).otherwise(F.coalesce("openalex", "_canon")).alias("openalex"),
        "s2",
        F.coalesce(low & (F.col("_canon") > F.col("openalex")), F.lit(False)).alias("corrected"),
    )


def attach(rows: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Counts joined to rows: a new count replaces the old, a missing one doesn't; ``updated`` marks keys that were found."""
    missing = {"openalex", "s2"} - set(counts.columns)
    if missing:
        raise KeyError(f"counts lack {sorted(missing)}")
    c = counts.select(F.col("key").alias(key), F.col("openalex").alias("_o"), F.col("s2").alias("_s"), F.lit(True).alias("_hit"))
    return rows.join(c, key, "left").withColumns(
        {"cite_openalex": F.coalesce("_o", "cite_openalex"), "cite_s2": F.coalesce("_s", "cite_s2"), "updated": F.coalesce("_hit", F.lit(False))}
    ).drop("_o", "_s", "_hit")
