"""Downloaded files: newest first, checked by their first bytes."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_pdf(content: Column) -> Column:
    """Whether a body begins as a PDF does."""
    return F.substring(content, 1, 4) == F.lit(b"%PDF")


def recent_pdfs(spark: SparkSession, folder: str, hours: float | None = None) -> DataFrame:
    """path, modified, length, is_pdf of the PDF files of a folder changed within ``hours``, to be taken newest first."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf")
    if hours is not None:
        since = datetime.now(timezone.utc) - timedelta(hours=hours)
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
    return reader.load(folder).select("path", F.col("modificationTime").alias("modified"), "length", is_pdf(F.col("content")).alias("is_pdf")).orderBy(F.col("modified").desc(), "path")


def candidates(arxiv: str | None, doi_urls: list[str], pmcid: str | None) -> list[tuple[str, str]]:
    """(source, address) in the order in which a paper's file is sought: preprint server, open copies, archive."""
    out = [("arxiv", f"https://arxiv.org/pdf/{arxiv}.pdf")] if arxiv else []
    out += [("unpaywall", u) for u in doi_urls]
    return out + ([("europepmc", f"https://europepmc.org/articles/{pmcid}?pdf=render")] if pmcid else [])


def download(slug: str, sources: list[tuple[str, str]], folder: str, get, blocked: tuple[str, ...] = (), least: int = 5000) -> tuple[str, int, str | None]:
    """(status, bytes, address): the first body that is a PDF is written to ``folder``; 'exists' if a file of ``least`` bytes is there, 'FAIL' if none could be had.

    ``get`` returns a body or raises; addresses with a ``blocked`` part aren't asked.
    """
    from pathlib import Path

    target = Path(folder) / f"{slug}.pdf"
    if target.exists() and target.stat().st_size > least:
        return "exists", target.stat().st_size, None
    for source, url in sources:
        if any(b in url for b in blocked):
            continue
        try:
            body = get(url)
        except Exception:
            continue
        if body[:4] == b"%PDF":
            target.write_bytes(body)
            return source, len(body), url
    return "FAIL", 0, None


def rename(moves: list[tuple[str, str]], folder: str, dry: bool = True) -> list[tuple[str, str]]:
    """(from, to) of files moved to their slugs; nothing is moved while ``dry``, and no existing file is replaced."""
    from pathlib import Path

    done = []
    for name, slug in moves:
        src, dst = Path(name), Path(folder) / f"{slug}.pdf"
        if src.exists() and not dst.exists():
            done.append((str(src), str(dst)))
            if not dry:
                src.rename(dst)
    return done
