"""Record files: JSON arrays, JSON lines and standard input, each row with its input position."""

from __future__ import annotations

import json
import sys
from typing import IO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(fields: str) -> T.StructType:
    return T.StructType([T.StructField(n, {"b": T.LongType(), "i": T.IntegerType(), "a": T.ArrayType(T.StringType())}.get(k, T.StringType())) for n, _, k in (f.partition(":") for f in fields.split())])


ROWS = _struct("ref label topic apa link doi arxiv venue title year:i summary tag pdf xref source family cite_openalex:b cite_s2:b canonical_at")
CITATIONS = _struct("label pmcid pmid doi arxiv title expect_first_author expect_year")
PAPERS = _struct("slug doi pdf arxiv pmcid")
LAB_PAPERS = _struct("openalex doi link title year:i venue apa cite_openalex:b topic topics:a summary coauthors:a type ref")
MANIFEST = _struct("slug title first_author year doi")


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of a UTF-8 JSON array file with ``row_pos`` from 0, their place in the file. A file is one record: for large data use :func:`json_lines`."""
    whole = spark.read.text(path, wholetext=True)
    items = whole.select(F.from_json("value", T.ArrayType(schema), {"mode": "PERMISSIVE"}).alias("a"))
    return items.select(F.posexplode("a").alias("row_pos", "r")).select(F.col("row_pos").cast("bigint").alias("row_pos"), "r.*")


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object per line, split over tasks; malformed lines are kept in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def from_stdin(spark: SparkSession, schema: T.StructType, stream: IO[str] | None = None) -> DataFrame:
    """The JSON array on standard input, with ``row_pos``; numbers in text fields become text."""
    records = json.load(stream or sys.stdin)
    text = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    rows = [(i, *((str(r[f.name]) if f.name in text and r.get(f.name) is not None else r.get(f.name)) for f in schema.fields)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("row_pos", T.LongType()), *schema.fields]))


def key_column(df: DataFrame, key: str | None = None) -> str:
    """The row key: the one given, else ``ref`` if the first row has it, else ``label``."""
    if key:
        return key
    first = df.select("ref").head(1) if "ref" in df.columns else []
    return "ref" if first and first[0][0] is not None else "label"


def keyed(df: DataFrame, key: str | None = None) -> DataFrame:
    """``df`` with its row key as ``key``."""
    return df.withColumn("key", F.col(key_column(df, key)))


def reference_tail(text: Column) -> Column:
    """What follows the first line that is a References or Bibliography header; the whole text without one."""
    return F.regexp_replace(text, r"(?is)^.*?\n(references|bibliography)[ \t]*\n", "")
