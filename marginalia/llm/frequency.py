"""Exact frequencies of terms and of the records they stand in, by radix partitions aggregated out of core."""

from __future__ import annotations

import os
import shutil
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.doi import norm_doi
from marginalia.session import cut, shared_dir

#: Hash bits of one level of the recursion.
BITS = 6
#: Levels that split by the term's hash; below them a piece is split by the record's hash.
TERM_LEVELS = 4


def _bits(h: str, level: int) -> Column:
    return F.shiftrightunsigned(F.col(h), level * BITS).bitwiseAND((1 << BITS) - 1)


def _aggregate(memory: str, spill: str):
    """Aggregate the (piece, term, record, n) rows of a partition with DuckDB, which spills beyond ``memory``."""

    def run(batches):
        import duckdb

        home = os.path.join(spill, uuid.uuid4().hex) if spill else ""
        con = duckdb.connect(config={"memory_limit": memory, "threads": "1", "preserve_insertion_order": "false"})
        try:
            con.execute(f"set temp_directory = '{home}'")
            con.execute("create temp table t (term varchar, n bigint)")
            for batch in batches:
                if batch.num_rows:
                    con.register("b", pa.Table.from_batches([batch]))
                    con.execute("insert into t select term, n from b")
                    con.unregister("b")
            out = con.execute("select term, count(*)::bigint as records, sum(n)::bigint as entries from t group by term")
            reader = getattr(out, "to_arrow_reader", None) or out.fetch_record_batch
            yield from reader(50_000)
        finally:
            con.close()
            if home:
                shutil.rmtree(home, ignore_errors=True)

    return run


def term_frequency(
    occurrences: DataFrame, term: str, record: str, max_piece_rows: int = 2_000_000, memory: str = "256MB"
) -> DataFrame:
    """How often every ``term`` occurs and in how many distinct ``record``; columns term, records, entries.

    Repeats within a record are added up before anything else moves. The (term, record) pairs are then split by
    ``BITS`` bits of the term's hash; a piece of more than ``max_piece_rows`` pairs is split by the next bits, and so on,
    and what one term alone makes oversized is split by the record's hash. Only the sizes of pieces come to the driver, at most 2**BITS for each
    oversized piece, of which there are no more than pairs / ``max_piece_rows``; a level reads two columns of hashes. Each piece is aggregated by DuckDB within
    ``memory``, spilling into the shared folder; on an object store, which can't hold its spill files, pieces are a quarter of the size, so that they fit
    in memory. A term split over pieces is added up at the end (its records don't overlap).

    Defined cases: NULL terms are left out; a NULL record counts as one record; extra columns are ignored; empty input, empty result.
    """
    spark = occurrences.sparkSession
    pairs = (
        occurrences.select(F.col(term).cast("string").alias("term"), F.col(record).cast("string").alias("record"))
        .where("term is not null")
        .groupBy("term", "record")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    pairs = cut(pairs.select("term", "n", F.xxhash64("term").alias("ht"), F.xxhash64("record", "term").alias("hr")))
    spill = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    if "://" in spill:
        spill, max_piece_rows = "", max(1, max_piece_rows // 4)
    # every row starts in piece 0, which is always split, and walks down as long as its piece is oversized
    path, opened, open_pieces, sizes = [F.lit(0).cast("bigint")], [], {0}, {}
    while open_pieces and len(path) <= TERM_LEVELS + 60 // BITS:
        level = len(opened)
        h, at = ("ht", level) if level < TERM_LEVELS else ("hr", level - TERM_LEVELS)
        path.append(path[-1] * F.lit(1 << BITS) + F.lit(1) + _bits(h, at))
        opened.append(sorted(open_pieces))
        children = pairs.where(path[level].isin(opened[level])).groupBy(path[level + 1].alias("piece")).count()
        found = {r["piece"]: r["count"] for r in children.toLocalIterator()}
        sizes = {p: n for p, n in sizes.items() if p not in open_pieces} | found
        open_pieces = {p for p, n in found.items() if n > max_piece_rows}
    piece = path[len(opened)]
    for level in range(len(opened) - 1, -1, -1):
        piece = F.when(path[level].isin(opened[level]), piece).otherwise(path[level])
    total = sum(sizes.values())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * total // max_piece_rows)
    placed = pairs.withColumn("piece", piece)
    partial = placed.repartition(parts, "piece").select("term", "n").mapInArrow(_aggregate(memory, spill), "term string, records bigint, entries bigint")
    return partial.groupBy("term").agg(F.sum("records").alias("records"), F.sum("entries").alias("entries"))


def mark(freq: DataFrame, total: int | Column, rare: int = 1, common: float = 0.02) -> DataFrame:
    """Add ``mark``: 'rare' for terms in at most ``rare`` records, 'common' for those in more than ``common`` of ``total``; else NULL.

    A term that is both (tiny collections) counts as rare.
    """
    total = total if isinstance(total, Column) else F.lit(total)
    return freq.withColumn(
        "mark", F.when(F.col("records") <= rare, "rare").when(F.col("records") > common * total, "common")
    )


def doi_frequency(xref: DataFrame, **params) -> DataFrame:
    """Entries and citing papers of every cited DOI, with its mark; columns doi, records, entries, mark.

    An entry without a slug counts as an entry but as no citing paper; a DOI only such entries cite is unmarked.
    """
    named = xref.select(norm_doi(F.col("doi")).alias("doi"), "slug")
    total = xref.where("slug is not null").select("slug").distinct().count()
    cited = mark(term_frequency(named.where("slug is not null"), "doi", "slug", **params), total)
    loose = named.where("slug is null and doi is not null").groupBy(F.col("doi").alias("term")).agg(F.count(F.lit(1)).alias("loose"))
    return cited.join(loose, "term", "full").select(
        F.col("term").alias("doi"),
        F.coalesce("records", F.lit(0)).alias("records"),
        (F.coalesce("entries", F.lit(0)) + F.coalesce("loose", F.lit(0))).alias("entries"),
        "mark",
    )
