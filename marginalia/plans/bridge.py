"""Bibliographic views over the order tables, as one SQL text that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.session import table


def rows_sql(text: str) -> str:
    """The rows: one paper per order. ``text`` is the dialect's string type."""
    return f"""
select o_orderkey as row_pos, concat('R', cast(o_orderkey as {text})) as ref,
  case when o_orderkey % 13 = 0 then null
       when o_orderkey % 11 = 0 then concat('10.48550/arXiv.', cast(o_orderkey as {text}))
       else concat('10.1000/', cast(o_orderkey as {text})) end as doi,
  year(o_orderdate) as year, o_orderpriority as topic,
  concat(upper(substring(c_mktsegment,1,1)), lower(substring(c_mktsegment,2))) as family,
  case o_orderstatus when 'F' then 'search' when 'O' then 'xref' else 'anteced' end as source,
  case when o_orderkey % 17 = 0 then null else cast(floor(o_totalprice/1000) as bigint) end as cite_openalex,
  case when o_orderkey % 5 = 0 then null else cast(floor(o_totalprice/900) as bigint) end as cite_s2
from orders join customer on o_custkey = c_custkey"""


EDGES_SQL = "select l_orderkey as citing, l_partkey as cited, min(l_orderkey * 8 + l_linenumber) as pos from lineitem group by 1, 2"


def _views(spark: SparkSession, d: str, *names: str) -> None:
    for n in names:
        table(spark, d, n).createOrReplaceTempView(n)


def rows(spark: SparkSession, d: str) -> DataFrame:
    _views(spark, d, "orders", "customer")
    return spark.sql(rows_sql("string"))


def edges(spark: SparkSession, d: str) -> DataFrame:
    _views(spark, d, "lineitem")
    return spark.sql(EDGES_SQL)
