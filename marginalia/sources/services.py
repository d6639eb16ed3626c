"""Payloads of bibliographic services: normalised records, three-valued lookups, batched fetching."""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: HTTP statuses that mean "later", not "absent".
TRANSIENT = frozenset({429, 500, 502, 503, 504})
DATE = "struct<`date-parts`:array<array<int>>>"
MESSAGE = (
    "struct<title:array<string>,subtitle:array<string>,author:array<struct<family:string,given:string>>,`published-print`:" + DATE + ",`published-online`:" + DATE + ",issued:" + DATE
    + ",`container-title`:array<string>,institution:string,`group-title`:string,volume:string,issue:string,page:string,"
    "reference:array<struct<DOI:string,author:string,year:string,`article-title`:string,`journal-title`:string,unstructured:string>>>"
)


def is_transient(error: Exception) -> bool:
    """Whether a failed request is worth repeating."""
    if isinstance(error, urllib.error.HTTPError):
        return error.code in TRANSIENT
    return isinstance(error, (urllib.error.URLError, TimeoutError, ConnectionError))


def fetch(url: str, agent: str, opener: Callable = urllib.request.urlopen, tries: int = 5, wait: Callable = time.sleep, timeout: float = 30) -> bytes:
    """The body of ``url``; transient statuses wait 3·2ⁿ seconds, unreachable hosts 2·2ⁿ, anything else is raised at once."""
    for n in range(tries):
        try:
            with opener(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
                return r.read()
        except Exception as e:
            if not is_transient(e) or n == tries - 1:
                raise
            wait((3 if isinstance(e, urllib.error.HTTPError) else 2) * 2**n)
    raise AssertionError("unreachable")


def _first(c: Column) -> Column:
    return F.nullif(F.trim(F.get(c, F.lit(0))), F.lit(""))


def crossref_record(m: Column, venue: Column) -> Column:
    """struct(title, year, first_author, people, journal, volume, issue, pages) of a work's message.

    The year is that of print, else online, else issue; authors without family name are left out; the journal falls back to institution,
    group and the caller's venue without its parenthesis; a subtitle is joined by a colon unless the title has it.
    """
    from marginalia.functions.names import person
    from marginalia.functions.titles import clean_venue

    year = lambda f: F.get(F.get(m[f]["date-parts"], F.lit(0)), F.lit(0))
    main, sub = F.coalesce(_first(m["title"]), F.lit("")), F.coalesce(_first(m["subtitle"]), F.lit(""))
    bare = F.regexp_replace(main, r":\s*$", "")
    capital = F.concat(F.upper(F.left(sub, F.lit(1))), F.substring(sub, F.lit(2), F.length(sub)))
    joined = F.when((sub == "") | F.contains(F.lower(main), F.lower(sub)), main).otherwise(F.concat(bare, F.lit(": "), capital))
    named = F.filter(F.coalesce(m["author"], F.array()), lambda a: F.coalesce(a["family"], F.lit("")) != "")
    lead = F.get(named, F.lit(0))
    return F.struct(
        joined.alias("title"),
        F.coalesce(year("published-print"), year("published-online"), year("issued")).cast("string").alias("year"),
        F.trim(F.concat_ws(" ", lead["family"], F.left(lead["given"], F.lit(1)))).alias("first_author"),
        F.transform(named, lambda a: person(a["family"], a["given"])).alias("people"),
        F.coalesce(_first(m["container-title"]), F.nullif(m["institution"], F.lit("")), F.nullif(m["group-title"], F.lit("")), clean_venue(venue)).alias("journal"),
        m["volume"].alias("volume"), m["issue"].alias("issue"), m["page"].alias("pages"),
    )


def reference_edges(works: DataFrame, slug: str = "slug", message: str = "message") -> DataFrame:
    """One row per entry of every work's reference list: slug, list_pos, doi in lower case, author, year, title, journal, raw."""
    e = works.select(slug, F.posexplode(F.col(message)["reference"]).alias("list_pos", "r"))
    return e.select(slug, "list_pos", F.lower("r.DOI").alias("doi"), "r.author", "r.year", F.col("r.article-title").alias("title"), F.col("r.journal-title").alias("journal"), F.col("r.unstructured").alias("raw"))


_ENTRY = "struct<id:string,title:string,published:string,author:array<struct<name:string>>,journal_ref:string>"


def arxiv_entries(feeds: DataFrame, xml: str = "feed") -> DataFrame:
    """id without version, title, year, first_author, people and journal_ref of every entry of Atom feeds; error entries are left out."""
    plain = F.regexp_replace(F.col(xml), "arxiv:journal_ref", "journal_ref")
    e = feeds.select(F.from_xml(plain, f"entry array<{_ENTRY}>").alias("f")).select(F.explode("f.entry").alias("e"))
    flat = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    names = F.transform("e.author", lambda a: a["name"])
    return e.where(flat(F.col("e.title")) != "Error").select(
        F.regexp_replace(F.regexp_extract("e.id", r"([^/]+)$", 1), r"v\d+$", "").alias("id"), flat(F.col("e.title")).alias("title"), F.left("e.published", F.lit(4)).alias("year"),
        F.get(names, F.lit(0)).alias("first_author"), names.alias("people"), flat(F.col("e.journal_ref")).alias("journal_ref"),
    )


class _Batch(InputPartition):
    def __init__(self, batches: list[list[str]]):
        self.batches = batches


def _bare(key: object) -> str:
    return re.sub(r"^https?://(dx\.)?doi\.(org|example)/", "", str(key or "").lower())


def answers(body: object, ids: list[str], items: str = "", key: str = "") -> dict[str, object]:
    """What a response says about each id: ``items`` is the path to its records, an object by id or a list of records.

    A list is read by each record's ``key`` field, compared in lower case without a resolver, or by position if ``key`` is '#'.
    """
    for step in filter(None, items.split(".")):
        body = (body or {}).get(step)
    if isinstance(body, list):
        if key == "#":
            return {i: r for i, r in zip(ids, body) if r is not None}
        by = {_bare(r.get(key)): r for r in reversed(body) if isinstance(r, dict)}
        return {i: by[_bare(i)] for i in ids if _bare(i) in by}
    return {i: body[i] for i in ids if isinstance(body, dict) and body.get(i) is not None}


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[_Batch]:
        once, size = list(dict.fromkeys(json.loads(self.options["ids"]))), int(self.options.get("batch", "50"))
        batches = [once[i : i + size] for i in range(0, len(once), size)]
        # a service that asks for pauses is asked by one task, one batch after the other
        return [_Batch(batches)] if float(self.options.get("pause", "0")) else [_Batch([b]) for b in batches]

    def read(self, partition: _Batch) -> Iterator[tuple]:
        for n, ids in enumerate(partition.batches):
            if n:
                time.sleep(float(self.options.get("pause", "0")))
            try:
                body = json.loads(fetch(self.options["url"].replace("{ids}", "|".join(ids)), self.options["agent"]))
            except Exception as e:
                status = "transient" if is_transient(e) else "miss"
                yield from ((i, status, None) for i in ids)
                continue
            found = answers(body, ids, self.options.get("items", ""), self.options.get("key", ""))
            yield from ((i, "hit", json.dumps(found[i])) if i in found else (i, "miss", None) for i in ids)


class LookupSource(DataSource):
    """Batched lookups over HTTP: one partition per batch of ids, one row (id, status, payload) per id.

    Options: ``ids`` (JSON list), ``url`` with ``{ids}``, ``agent`` (with a contact address), ``batch``, ``pause`` (seconds between
    batches, which then run in one task), ``items`` and ``key`` (see :func:`answers`). A batch that fails for good is a miss, one that
    couldn't complete is transient for all its ids.
    """

    @classmethod
    def name(cls) -> str:
        return "lookup"

    def schema(self) -> str:
        return "id string, status string, payload string"

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


# --- stored or fetched payloads of single services ----------------------------------------------
_SUMMARY = "struct<uid:string,title:string,pubdate:string,authors:array<struct<name:string>>,source:string>"


def summary_records(payloads: DataFrame, uid: str = "uid", body: str = "body") -> DataFrame:
    """id, status, title, year, first_author and journal of life-science summary payloads, one per id (a ``PMC`` before it is dropped).

    A payload without the id's own record is a miss; one that is NULL couldn't be fetched and is transient.
    """
    plain = F.regexp_replace(F.col(uid), "^PMC", "")
    r = F.from_json(F.get_json_object(F.col(body), "$.result"), "map<string,string>")[plain]
    rec = F.from_json(r, _SUMMARY)
    status = F.when(F.col(body).isNull(), "transient").when(F.col("r.uid").isNull(), "miss").otherwise("hit")
    found = F.col("r.uid").isNotNull()
    return payloads.withColumn("r", rec).select(
        F.col(uid).alias("id"), status.alias("status"), F.when(found, F.coalesce("r.title", F.lit(""))).alias("title"), F.when(found, F.left(F.coalesce("r.pubdate", F.lit("")), F.lit(4))).alias("year"),
        F.when(found, F.coalesce(F.get("r.authors", F.lit(0))["name"], F.lit(""))).alias("first_author"), F.when(found, F.coalesce("r.source", F.lit(""))).alias("journal"),
    )


def search_hits(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The payloads of a title search with ``hit``: the id of its first result, NULL without one."""
    ids = F.from_json(F.get_json_object(F.col(body), "$.esearchresult.idlist"), "array<string>")
    return payloads.withColumn("hit", F.get(ids, F.lit(0)))


def work_counts(pages: DataFrame, body: str = "body") -> DataFrame:
    """(doi, count) from pages of works: several works of one DOI (a primary and its stubs) count as the highest of them."""
    works = pages.select(F.explode(F.from_json(F.get_json_object(F.col(body), "$.results"), "array<struct<doi:string,cited_by_count:bigint>>")).alias("w"))
    doi = F.nullif(F.replace(F.lower("w.doi"), F.lit("https://doi.org/"), F.lit("")), F.lit(""))
    return works.select(doi.alias("doi"), F.col("w.cited_by_count").alias("n")).where("doi is not null and n is not null").groupBy("doi").agg(F.max("n").alias("count"))


def single_count(body: Column) -> Column:
    """The count of one work's own payload."""
    return F.get_json_object(body, "$.cited_by_count").try_cast("bigint")


def positional_counts(batches: DataFrame, ids: str = "ids", body: str = "body") -> DataFrame:
    """(id, count, influential) of batches answered by position: the n-th entry belongs to the n-th id asked for; NULL entries and counts are misses."""
    found = F.from_json(F.col(body), "array<struct<citationCount:bigint,influentialCitationCount:bigint>>")
    pairs = batches.select(F.explode(F.arrays_zip(F.col(ids).alias("id"), found.alias("e"))).alias("p"))
    return pairs.select("p.id", F.col("p.e.citationCount").alias("count"), F.col("p.e.influentialCitationCount").alias("influential")).where("id is not null and count is not null")


_AUTHOR = "array<struct<id:string,display_name:string,orcid:string,works_count:bigint,cited_by_count:bigint,last_known_institutions:array<struct<display_name:string>>,counts_by_year:array<struct<year:int>>>>"


def author_candidates(payloads: DataFrame, body: str = "body", limit: int = 45) -> DataFrame:
    """The candidates of author searches: id, name, orcid, works, cites, institutions, first and last year.

    ``merged`` marks careers of more than ``limit`` years, ``only`` a search with one candidate: both may be several people under one id.
    """
    found = payloads.select(F.from_json(F.get_json_object(F.col(body), "$.results"), _AUTHOR).alias("a"))
    one = found.select(F.explode("a").alias("x"), (F.size("a") == 1).alias("only"))
    years = F.transform("x.counts_by_year", lambda c: c["year"])
    first, last = F.array_min(years), F.array_max(years)
    return one.select(
        F.regexp_extract("x.id", "([^/]*)$", 1).alias("author_id"), F.col("x.display_name").alias("name"), F.nullif(F.replace("x.orcid", F.lit("https://orcid.org/"), F.lit("")), F.lit("")).alias("orcid"),
        F.col("x.works_count").alias("works"), F.col("x.cited_by_count").alias("cites"), F.transform("x.last_known_institutions", lambda i: i["display_name"]).alias("institutions"),
        first.alias("first_year"), last.alias("last_year"), F.coalesce(last - first > limit, F.lit(False)).alias("merged"), "only",
    )


_WORK = (
    "array<struct<id:string,doi:string,title:string,publication_year:int,cited_by_count:bigint,type:string,topics:array<struct<display_name:string>>,primary_location:struct<source:struct<display_name:string>>,"
    "abstract_inverted_index:map<string,array<int>>,authorships:array<struct<author:struct<display_name:string>>>,biblio:struct<volume:string,issue:string,first_page:string,last_page:string>>>"
)


def works(pages: DataFrame, body: str = "body") -> DataFrame:
    """The works of fetched pages as the columns of a list of works, with volume, issue, pages (joined by a hyphen, blanks skipped) and the text of the abstract."""
    from marginalia.functions.titles import unabstract

    w = pages.select(F.explode(F.from_json(F.get_json_object(F.col(body), "$.results"), _WORK)).alias("w")).select("w.*")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return w.select(
        F.col("id").alias("openalex"), "doi", F.col("doi").alias("link"), "title", F.col("publication_year").alias("year"), F.col("primary_location.source.display_name").alias("venue"),
        F.col("cited_by_count").alias("cite_openalex"), F.transform("topics", lambda t: t["display_name"]).alias("topics"), unabstract(F.col("abstract_inverted_index")).alias("summary"),
        F.transform("authorships", lambda a: a["author"]["display_name"]).alias("coauthors"), "type",
        F.col("biblio.volume").alias("volume"), F.col("biblio.issue").alias("issue"), F.nullif(F.concat_ws("-", blank("biblio.first_page"), blank("biblio.last_page")), F.lit("")).alias("pages"),
    )


def cursor_pages(get: Callable[[str], bytes], url: str, wait: Callable = time.sleep, pause: float = 0.3) -> Iterator[str]:
    """The bodies of all pages of a listing; ``url`` has ``{cursor}``. The next cursor is in the page's ``meta``; pages are fetched one after the other."""
    from urllib.parse import quote

    cursor = "*"
    while cursor:
        body = get(url.replace("{cursor}", quote(cursor))).decode()
        yield body
        cursor = (json.loads(body).get("meta") or {}).get("next_cursor")
        if cursor:
            wait(pause)


def post_batch(url: str, ids: list[str], agent: str, opener: Callable = urllib.request.urlopen, tries: int = 4, wait: Callable = time.sleep) -> str | None:
    """The body answered to a list of ids sent at once; refusals wait 15 s, 30 s, …, other failures 10 s; None if all tries fail, so what is known stands."""
    request = urllib.request.Request(url, json.dumps({"ids": ids}).encode(), {"User-Agent": agent, "Content-Type": "application/json"})
    for n in range(1, tries + 1):
        try:
            with opener(request, timeout=60) as r:
                return r.read().decode()
        except urllib.error.HTTPError:
            wait(15 * n)
        except (OSError, ValueError):
            wait(10)
    return None
