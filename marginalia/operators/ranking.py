"""Ranks within groups, distribution transforms and landmark selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.session import cut


def cites(openalex: str = "cite_openalex", s2: str = "cite_s2") -> Column:
    """The higher of two counts, -1 without any."""
    return F.coalesce(F.greatest(openalex, s2), F.lit(-1))


def last_by_key(df: DataFrame, key: str, pos: str = "row_pos") -> DataFrame:
    """The last row of every key (later rows overwrite earlier ones)."""
    # "_n = 1" lets Spark keep one row per key and task before the shuffle, so a hot key travels once per task
    w = Window.partitionBy(key).orderBy(F.col(pos).desc())
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_by_key(df: DataFrame, key: str, pos: str = "row_pos") -> DataFrame:
    """The first row of every key; rows without a key are kept each."""
    w = Window.partitionBy(key).orderBy(pos)
    first = df.where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return first.unionByName(df.where(F.col(key).isNull()))


def top_per_group(df: DataFrame, group: str, n: int, score: Column, *ties: str) -> DataFrame:
    """The ``n`` best rows of every group with their rank; Spark keeps n rows per group and task before the shuffle."""
    w = Window.partitionBy(group).orderBy(score.desc(), *ties)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def landmarks(
    papers: DataFrame, per_family: int = 4, motif_min: int = 3, max_labels: int = 28, key: str = "ref", family: str = "family"
) -> DataFrame:
    """The papers to label: lab papers, those cited within the corpus, the most cited of every family; at most ``max_labels``.

    ``papers`` has key, family, is_lab, indegree, cites. Beyond the cap lab papers and two of every family stay and the
    rest is filled by in-degree, then counts, then key; what stays unconditionally may exceed the cap.
    """
    w = Window.partitionBy(family).orderBy(F.col("cites").desc(), key)
    ranked = papers.withColumn("fam_rank", F.row_number().over(w))
    chosen = ranked.where(F.col("is_lab") | (F.col("indegree") >= motif_min) | (F.col("fam_rank") <= per_family))
    kept = F.col("is_lab") | (F.col("fam_rank") <= 2)
    sizes = chosen.agg(F.count(F.lit(1)).alias("n_all"), F.count_if(kept).alias("n_kept"))
    # the fill is bounded by the cap: a global top-k, not a sort of everything
    fill = chosen.where(~kept).orderBy(F.col("indegree").desc(), F.col("cites").desc(), key).limit(max_labels)
    w2 = Window.orderBy(F.col("indegree").desc(), F.col("cites").desc(), key)
    numbered = fill.withColumn("pool_rank", F.row_number().over(w2)).select(key, "pool_rank")
    return (
        chosen.join(F.broadcast(sizes))
        .join(F.broadcast(numbered), key, "left")
        .where((F.col("n_all") <= max_labels) | kept | (F.col("pool_rank") <= F.lit(max_labels) - F.col("n_kept")))
        .select(key, family, "is_lab", "indegree", "cites", (F.col("n_all") > max_labels).alias("capped"))
    )


def midrank_cdf(df: DataFrame, value: str) -> DataFrame:
    """(value, n, cdf): the midpoint rank (#below + #at or below) / 2 / N of every distinct value.

    Values are counted first, so the window runs over distinct values, not over rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return counts.withColumn("cdf", (2 * upto - F.col("n")) / 2 / total)


def warped_axis(years: DataFrame, value: str, warp: float, min_year: int | None = None) -> DataFrame:
    """(value, x): the place of every distinct year on an axis blended from the line and the distribution; x in [0, 1]."""
    w = max(0.0, min(1.0, warp))
    cdf = midrank_cdf(years, value)
    span = cdf.agg((F.min(value) - 3 if min_year is None else F.lit(min_year)).alias("lo"), (F.max(value) + 2).alias("hi"))
    c = F.col("cdf")
    at_lo = cdf.join(F.broadcast(span)).agg(
        F.first("lo").alias("lo"), F.first("hi").alias("hi"),
        (F.sum(F.when(F.col(value) < F.col("lo"), F.col("n") * 2).when(F.col(value) == F.col("lo"), F.col("n")).otherwise(0)) / 2 / F.sum("n")).alias("c_lo"),
    )
    span_c = F.when(F.lit(1.0) - F.col("c_lo") == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.col("c_lo"))
    y = F.least(F.greatest(F.col(value), F.col("lo")), F.col("hi"))
    lin = (y - F.col("lo")) / (F.col("hi") - F.col("lo"))
    at = F.when(F.col(value) < F.col("lo"), F.col("c_lo")).otherwise(c)
    return cdf.join(F.broadcast(at_lo)).select(value, (F.lit(1 - w) * lin + F.lit(w) * (at - F.col("c_lo")) / span_c).alias("x"))


def ranked(df: DataFrame, rank: str, *order: Column | str) -> DataFrame:
    """``df`` with its 1-based place in a global order, without one task sorting all.

    The rows are laid out in sorted ranges once and written; places within a range and the sizes of the ranges before it both come from
    what was written, so they fit each other however the range bounds were sampled.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism
    laid = cut(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()))
    local = laid.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = laid.groupBy("_p").agg(F.count(F.lit(1)).alias("_size"))  # one row per range
    before = sizes.select("_p", F.coalesce(F.sum("_size").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return local.join(F.broadcast(before), "_p").withColumn(rank, F.col("_n") + F.col("_before")).drop("_p", "_n", "_before")


def numbered(df: DataFrame, label: str, *order: Column | str, prefix: str = "L") -> DataFrame:
    """Sequential labels L1, L2, … in a global order."""
    return ranked(df, label, *order).withColumn(label, F.concat(F.lit(prefix), F.col(label).cast("string")))
