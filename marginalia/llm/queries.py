"""The pN_ queries: each problem's operator over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import abuse, confusables, frequency, leakage, mojibake, names, neardup, tokens, topn
from marginalia.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.family_top_refs(table(spark, d, "paper_rows"), table(spark, d, "citation_counts"), n=5).select("family", "ref")


def p1_ranked(spark: SparkSession, d: str) -> DataFrame:
    top = topn.family_top_refs(table(spark, d, "paper_rows"), table(spark, d, "citation_counts"), n=5)
    return top.select("family", "ref", "score", "row_pos", F.col("rank").cast("bigint").alias("rank"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return frequency.doi_frequency(table(spark, d, "xref")).where("mark is not null").select("doi", "mark")


def p2_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return frequency.doi_frequency(table(spark, d, "xref"))


def _garbled(spark: SparkSession, d: str) -> DataFrame:
    apa = mojibake.garbled(table(spark, d, "paper_rows"), ["row_pos"], "apa")
    title = mojibake.garbled(table(spark, d, "lab_papers"), ["row_pos"], "title")
    return apa.withColumn("tbl", F.lit("paper_rows")).unionByName(title.withColumn("tbl", F.lit("lab_papers")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d).select("tbl", "row_pos")


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d).select("tbl", "row_pos", "text", "fixed", "path")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.same_paper_pairs(table(spark, d, "paper_rows"))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return neardup.same_paper_classes(table(spark, d, "paper_rows"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    apa = confusables.inconsistent(table(spark, d, "paper_rows"), ["row_pos"], "apa", skip_garbled=True)
    names = table(spark, d, "lab_papers").select("row_pos", F.explode("coauthors").alias("name"))
    lab = confusables.inconsistent(names, ["row_pos"], "name")
    return apa.select(F.lit("paper_rows").alias("tbl"), "row_pos").unionByName(
        lab.select(F.lit("lab_papers").alias("tbl"), "row_pos").distinct()
    )


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "lab_papers").select(F.explode("coauthors").alias("name"))
    return confusables.lookalike_groups(names.union(table(spark, d, "paper_rows").select("apa")), "name")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    reg = names.register(table(spark, d, "openalex_authors"))
    apa = names.link_references(table(spark, d, "paper_rows"), "row_pos", "apa", reg)
    people = table(spark, d, "lab_papers").select("row_pos", F.explode("coauthors").alias("name"))
    lab = names.link_names(people, "row_pos", "name", reg)
    return apa.select(F.lit("paper_rows").alias("tbl"), "row_pos", "author_id").unionByName(
        lab.select(F.lit("lab_papers").alias("tbl"), "row_pos", "author_id")
    )


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_ids(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id").distinct()


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_scores(spark, d).where("abusive").select("doc_id")


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return abuse.abuse_scores(docs, learned=abuse.learned_from(docs, table(spark, d, "labels")))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.abuse_rates(p9_scores(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_ranked": p1_ranked,
        "p2_found": p2_found,
        "p2_frequencies": p2_frequencies,
        "p3_found": p3_found,
        "p3_repaired": p3_repaired,
        "p4_found": p4_found,
        "p4_classes": p4_classes,
        "p5_found": p5_found,
        "p5_groups": p5_groups,
        "p6_found": p6_found,
        "p7_ids": p7_ids,
        "p8_found": p8_found,
        "p8_leaks": p8_leaks,
        "p9_found": p9_found,
        "p9_scores": p9_scores,
        "p9_rates": p9_rates,
    }
