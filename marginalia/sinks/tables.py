"""Tables: guarded overwrites, JSON arrays, follow-up lists."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most rows a report or a single JSON file may hold.
REPORT_ROWS = 100_000


class CanonicalTableError(RuntimeError):
    """The table to be overwritten holds canonical rows."""


def guarded_overwrite(df: DataFrame, path: str, force: bool = False) -> None:
    """Write a Parquet table; refuse if the one at ``path`` has any row stamped ``canonical_at``, unless forced. An unreadable one counts as empty.

    ``df`` must not read from ``path``.
    """
    if not force:
        try:
            old = df.sparkSession.read.parquet(path)
            stamped = "canonical_at" in old.columns and bool(old.where(F.coalesce("canonical_at", F.lit("")) != "").head(1))
        except AnalysisException:
            stamped = False
        if stamped:
            raise CanonicalTableError(f"{path} holds canonical rows")
    df.write.mode("overwrite").parquet(path)


def bounded(df: DataFrame, most: int = REPORT_ROWS) -> list[dict]:
    """The rows of a report as dictionaries; more than ``most`` is an error, not a cut."""
    rows = df.head(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write a table instead")
    return [r.asDict(recursive=True) for r in rows]


def json_array(df: DataFrame, path: str, indent: int = 1) -> int:
    """Write a bounded table as one UTF-8 JSON array file; the number of rows."""
    rows = bounded(df)
    Path(path).write_text(json.dumps(rows, ensure_ascii=False, indent=indent, default=str), encoding="utf-8")
    return len(rows)


def follow_up(df: DataFrame, path: str, status: str = "status") -> None:
    """Append the failed rows as lines of text."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c != status])
    df.where(F.col(status) == "FAIL").select(line.alias("value")).write.mode("append").text(path)
