"""Families of papers: assignment, validation, balance and cross-tabulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def resolve(assigned: DataFrame, families: DataFrame, raw: str = "family_raw") -> DataFrame:
    """``family``: the key whose key or name equals the raw value, trimmed and in any case; the raw value if none does.

    Names are registered after keys, later families override earlier ones.
    """
    names = families.select(F.lower(F.trim("key")).alias("n"), F.col("pos").alias("p"), F.lit(0).alias("k"), "key").union(
        families.select(F.lower(F.trim("name")), "pos", F.lit(1), "key")
    )
    best = names.where("n <> ''").groupBy("n").agg(F.max_by("key", F.struct("p", "k")).alias("_key"))
    return assigned.withColumn("n", F.lower(F.trim(raw))).join(best, "n", "left").withColumn("family", F.coalesce("_key", raw)).drop("n", "_key")


def violations(rows: DataFrame, assigned: DataFrame, families: DataFrame, least: int = 2, most: int = 9) -> DataFrame:
    """(step, gate, item) of every violated rule, in the order in which the first would stop a run."""
    key = lambda df, c: df.select(F.col(c).cast("string").alias("item"))
    dup = key(families.groupBy("key").count().where("count > 1"), "key")
    size = families.agg(F.countDistinct("key").alias("n")).where((F.col("n") < least) | (F.col("n") > most))
    missing = key(rows.select("ref").distinct().join(assigned.select("ref"), "ref", "left_anti"), "ref")
    extra = key(assigned.select("ref").distinct().join(rows.select("ref"), "ref", "left_anti"), "ref")
    bad = key(assigned.join(families, assigned["family"] == families["key"], "left_anti").select("family").distinct(), "family")
    named = [("duplicate-key", dup), ("family-count", key(size, "n")), ("missing", missing), ("extra", extra), ("unknown-key", bad)]
    out = None
    for step, (gate, df) in enumerate(named, 1):
        part = df.select(F.lit(step).alias("step"), F.lit(gate).alias("gate"), "item")
        out = part if out is None else out.union(part)
    return out


def gate(violated: DataFrame) -> None:
    """Raise at the first violated rule, in order, naming a few of its items."""
    first = violated.agg(F.min("step")).head()[0]
    if first is not None:
        bad = violated.where(F.col("step") == first).orderBy("item").head(20)
        raise ValueError(f"{bad[0]['gate']}: {[r['item'] for r in bad]}")


def balance(rows: DataFrame, family: Column, families: DataFrame | None = None) -> DataFrame:
    """Rows and share of every family, with a warning for empty, single and dominant (over 60 %) ones."""
    counted = rows.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("n"))
    if families is not None:
        counted = families.select(F.col("key").alias("family")).join(counted, "family", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = counted.agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    return counted.join(F.broadcast(total)).select(
        "family", "n", F.round(share, 6).alias("share"), F.when(F.col("n") == 0, "empty").when(F.col("n") == 1, "singleton").when(share > 0.6, "dominant").alias("warning")
    )


def crosstab(rows: DataFrame, family: Column, topic: Column) -> DataFrame:
    """(family, topic, n, family_total): the cells of the cross-tabulation that aren't empty."""
    cells = rows.groupBy(family.alias("family"), topic.alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("family_total", F.sum("n").over(Window.partitionBy("family")))


def pivoted(cells: DataFrame, topics: list[str], names: list[str]) -> DataFrame:
    """The cross-tabulation as a table: one column per given topic, NULL where empty, and the total."""
    aggs = [F.sum(F.when(F.col("topic") == t, F.col("n"))).alias(n) for t, n in zip(topics, names)]
    return cells.groupBy("family").agg(*aggs, F.sum("n").alias("total"))


def topic_codes(topics: DataFrame, topic: str = "topic") -> DataFrame:
    """A short code for every distinct topic: its leading mark 'X.' or four letters, numbered where taken, in order of topics."""
    t = topics.where(F.col(topic).isNotNull()).select(topic).distinct()
    word = F.coalesce(F.get(F.filter(F.split(topic, r"\s+"), lambda x: x != ""), F.lit(0)), F.lit("?"))
    base = F.when(F.col(topic).rlike(r"^\s*[A-Za-z0-9]+[.)]"), F.regexp_extract(topic, r"^\s*([A-Za-z0-9]+)[.)]", 1)).otherwise(
        F.coalesce(F.nullif(F.left(F.regexp_replace(word, "[^A-Za-z0-9]+", ""), F.lit(4)), F.lit("")), F.lit("?"))
    )
    n = F.row_number().over(Window.partitionBy("base").orderBy(topic))
    return t.withColumn("base", base).withColumn("n", n).select(topic, F.concat("base", F.when(F.col("n") > 1, F.col("n").cast("string")).otherwise("")).alias("code"))
