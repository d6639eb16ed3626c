"""Top N items within every group by partition lower bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.session import cut


def top_n(items: DataFrame, group: str, item: str, score: str, pos: str, n: int = 5) -> DataFrame:
    """The ``n`` best ``item`` of every ``group`` by (``score`` desc, ``pos`` asc); columns group, item, score, pos, rank.

    Every partition's local n-th best of a group is a lower bound of the group's n-th best: what lies below it is left where it lies, before anything
    moves. The survivors, at most ``n`` a group and partition however large the group, are written; the highest of a group's bounds filters them once more
    and what is left is ranked. All of it is sorted and limited in the JVM; nothing holds a group or a table of groups in memory.

    Defined cases: rows with a NULL group, item or pos are left out; a NULL score ranks as -1; equal (score, pos) are
    settled by the item's text; a repeated item keeps its best (score, pos); extra columns are dropped; an empty input gives an empty result.
    Items that already lie by their own hash (after a join on the item) are not moved to be made distinct.
    """
    base = items.select(
        F.col(group).cast("string").alias("g"),
        F.col(item).alias("i"),
        F.coalesce(F.col(score).cast("bigint"), F.lit(-1)).alias("s"),
        F.col(pos).cast("bigint").alias("p"),
    ).where("g is not null and i is not null and p is not null")
    reach = F.struct("s", (-F.col("p")).alias("q"))
    once = base.groupBy("g", "i").agg(F.max(reach).alias("b")).select("g", "i", "b.s", (-F.col("b.q")).alias("p"))
    best_first = (F.col("s").desc(), F.col("p"), F.col("i"))
    lies = Window.partitionBy("g", "t").orderBy(*best_first)
    # "n <= N" over a window lets Spark cut each partition's groups before the shuffle
    local = cut(once.withColumn("t", F.spark_partition_id()).withColumn("n", F.row_number().over(lies)).where(F.col("n") <= n).drop("t"))
    bound = local.where(F.col("n") == n).groupBy("g").agg(F.max(reach).alias("bound"))
    kept = local.hint("merge").join(bound.hint("merge"), "g", "left").where(F.col("bound").isNull() | (reach >= F.col("bound")))
    return (
        kept.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*best_first)))
        .where(F.col("rank") <= n)
        .select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score), F.col("p").alias(pos), "rank")
    )


def family_top_refs(rows: DataFrame, counts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` highest counted refs of every family of ``rows``; see :func:`top_n` for ties and defined cases.

    Families are compared trimmed and in lower case, null and empty left out; a ref stands at its smallest
    row_pos and scores the highest openalex or s2 count over its rows of ``counts``, -1 without one. Rows move once, by ref, to meet their count.
    """
    items = rows.select(F.lower(F.trim("family")).alias("family"), "ref", "row_pos").where("family <> '' and ref is not null")
    best = counts.where("key is not null").groupBy(F.col("key").alias("ref")).agg(F.max(F.greatest("openalex", "s2")).alias("score"))
    return top_n(items.hint("merge").join(best.hint("merge"), "ref", "left"), "family", "ref", "score", "row_pos", n)
