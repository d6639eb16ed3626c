"""Duplicate rows by link and by character similarity of titles."""

from __future__ import annotations

import difflib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_link(rows: DataFrame, pos: str = "row_pos") -> DataFrame:
    """Every pair of rows with the same link in any case; blank links don't count."""
    r = rows.where(F.coalesce(F.trim("link"), F.lit("")) != "").select(F.col(pos).alias("a"), F.lower(F.trim("link")).alias("link"))
    return r.join(r.withColumnRenamed("a", "b"), "link").where("a < b").select("a", "b", F.lit(1.0).alias("ratio"), F.lit("same DOI").alias("reason"))


#: Titles of a block; two blocks are compared by one task at a time.
BLOCK = 2000
_LETTERS = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789 ")}


def _neighbours(texts: list[str]) -> np.ndarray:
    """Which pairs of neighbouring characters each text holds."""
    out = np.zeros((len(texts), len(_LETTERS) ** 2), np.float32)
    for row, t in zip(out, texts):
        codes = [_LETTERS[c] for c in t]
        row[[a * len(_LETTERS) + b for a, b in zip(codes, codes[1:])]] = 1
    return out


def _places(text: str) -> dict[str, int]:
    """A bit for every place of each character."""
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _common(text: str, places: dict[str, int]) -> int:
    """The length of the longest common subsequence with the text of ``places``, all its places at once in one integer."""
    row = 0
    for c in text:
        x = row | places.get(c, 0)
        row = x & ((x - ((row << 1) | 1)) ^ x)
    return row.bit_count()


def _compare(threshold: float):
    """Compare the titles of two blocks (side 0 and 1; side 2: one block with itself): x, y and the ratio both ways of pairs that reach ``threshold``.

    Counts of letters are compared for all pairs at once. Of n + m characters the matching blocks of a pair hold M >= threshold (n + m) / 2, there are at most
    n + m - 2 M + 1 of them and each loses one pair of neighbours, which bounds the pairs of neighbours that two titles share. The blocks are a common
    subsequence, so the longest one bounds M too; only what passes all three is matched.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = pdf[pdf.side != 1].t.tolist(), pdf[pdf.side != 0].t.tolist()
        itself = bool((pdf.side == 2).all())
        tables = []
        for texts in (one, two):
            h = np.zeros((len(texts), len(_LETTERS)), np.int32)
            for row, t in zip(h, texts):
                for ch in t:
                    row[_LETTERS[ch]] += 1
            tables.append(h)
        a, b = tables
        total = a.sum(1)[:, None] + b.sum(1)[None, :]
        common = np.zeros_like(total)
        for k in range(len(_LETTERS)):
            common += np.minimum.outer(a[:, k], b[:, k])
        mask = (2 * common >= threshold * total - 1e-9) & (np.abs(a.sum(1)[:, None] - b.sum(1)[None, :]) <= 0.35 * np.maximum.outer(a.sum(1), b.sum(1)))
        if itself:
            mask = np.triu(mask, 1)
        shared, again = _neighbours(one) @ _neighbours(two).T, []
        for texts, held in ((one, _neighbours(one)), (two, _neighbours(two))):
            again.append(np.array([len(t) - 1 for t in texts]) - held.sum(1))  # pairs that stand more than once
        mask &= shared + np.minimum.outer(*again) + 1e-3 >= (threshold / 2 - (1 - threshold)) * total - 1
        found, matcher, last, at = [], difflib.SequenceMatcher(None), None, {}
        for j, i in np.argwhere(mask.T).tolist():
            x, y = one[i], two[j]
            if y is not last:
                last, at = y, _places(y)
            if 2 * _common(x, at) < threshold * (len(x) + len(y)) - 1e-9:
                continue
            if matcher.b is not y:
                matcher.set_seq2(y)
            matcher.set_seq1(x)
            xy, yx = matcher.ratio(), difflib.SequenceMatcher(None, y, x).ratio()
            if max(xy, yx) >= threshold:
                found.append((x, y, xy, yx))
        return pd.DataFrame(found, columns=["x", "y", "xy", "yx"])

    return run


def similar_titles(rows: DataFrame, threshold: float = 0.88, pos: str = "row_pos") -> DataFrame:
    """Pairs of rows whose normalised titles reach a matching-blocks ratio of ``threshold``.

    Equal titles are one class, compared once. Classes meet in buckets of the logarithm of their length (neighbouring
    buckets too), which loses no pair: the ratio bounds the lengths. Buckets are split into blocks of about BLOCK titles, however full they are, and
    every two blocks of like length are compared (see :func:`_compare`), so no bucket is one task's work. The work grows with the square of the distinct titles.
    """
    title = F.regexp_replace(F.lower("title"), "[^a-z0-9 ]", "")
    t = rows.where(F.col("title").isNotNull()).select(F.col(pos).alias("p"), title.alias("t"), F.lower(F.coalesce("link", F.lit(""))).contains("10.48550").alias("pre")).where("t <> ''")
    step = math.log((2 - threshold) / threshold)
    c = t.select("t").distinct().withColumn("k", F.floor(F.log(F.length("t").cast("double")) / step).cast("int"))
    # one number for each order of length
    many = {r["k"]: -(-r["count"] // BLOCK) for r in c.groupBy("k").count().collect()}
    none = F.array().cast("array<struct<k1:int,b1:int,k2:int,b2:int,side:int>>")
    size = lambda k: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kn in many.items() for x in kn)), k), F.lit(0)) if many else F.lit(0)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    k, blk = F.col("k"), F.col("b")
    cell = lambda k1, b1, k2, b2, side: F.struct(k1.alias("k1"), b1.alias("b1"), k2.alias("k2"), b2.alias("b2"), side.alias("side"))
    inside = F.transform(upto(size(k)), lambda j: cell(k, F.least(blk, j), k, F.greatest(blk, j), F.when(j == blk, 2).when(j > blk, 0).otherwise(1)))
    above = F.transform(upto(size(k + 1)), lambda j: cell(k, blk, k + 1, j, F.lit(0)))
    below = F.transform(upto(size(k - 1)), lambda j: cell(k - 1, j, k, blk, F.lit(1)))
    placed = c.withColumn("b", F.pmod(F.xxhash64("t"), F.greatest(size(k), F.lit(1))).cast("int")).select("t", F.explode(F.concat(none, inside, above, below)).alias("c")).select("t", "c.*")
    # the ratio depends on the order of the two, and rows of two classes may stand in either order
    both = placed.groupBy("k1", "b1", "k2", "b2").applyInPandas(_compare(threshold), "x string, y string, xy double, yx double")
    a, b = t.select(F.col("p").alias("pa"), F.col("t").alias("x"), F.col("pre").alias("ea")), t.select(F.col("p").alias("pb"), F.col("t").alias("y"), F.col("pre").alias("eb"))
    first = F.col("pa") < F.col("pb")
    across = both.join(a, "x").join(b, "y").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"), F.when(first, F.col("xy")).otherwise(F.col("yx")).alias("ratio"), "ea", "eb")
    equal = a.join(b.withColumnRenamed("y", "x"), "x").where("pa < pb").select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.lit(1.0).alias("ratio"), "ea", "eb")
    reason = F.when(F.col("ea") != F.col("eb"), "preprint vs published?").otherwise("near-identical title")
    return across.union(equal).where(F.col("ratio") >= threshold).select("a", "b", F.round("ratio", 6).alias("ratio"), reason.alias("reason"))
