"""Registered queries of the core operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import apa as A
from marginalia.functions import audit, citekeys, names, titles
from marginalia.functions import doi as D
from marginalia.functions.text import fold, unescape
from marginalia.operators import canonical, citecheck, counts, duplicates, families, graph, lab, layout, ranking, reconcile, references, verify
from marginalia.plans import bridge
from marginalia.session import table


#: The first year that a figure's axis shows.
FIRST_YEAR = 1990


def _rows(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "paper_rows")


def _lab(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lab_papers")


# --- the citation graph, over the order tables -------------------------------------------------
def internal_indegree(s, d):
    return graph.indegree(bridge.rows(s, d).select(F.col("row_pos").alias("key")), bridge.edges(s, d))


def xref_frequency(s, d):
    f = graph.citation_frequency(bridge.edges(s, d))
    return f.select("cited", "n_citations", "first_pos", F.array_join(F.transform("cited_by", lambda x: x.cast("string")), ",").alias("cited_by"))


def xref_ranked_minus_exclude(s, d):
    exclude = bridge.edges(s, d).select("cited").where("cited % 3 = 0").distinct()
    return graph.ranked_candidates(graph.citation_counts(bridge.edges(s, d)), exclude, "cited", 40)


def top_cited_per_family(s, d):
    return ranking.top_per_group(bridge.rows(s, d), "family", 4, ranking.cites(), "row_pos").select("family", "ref", ranking.cites().alias("cites"), F.col("rank").cast("bigint").alias("rank"))


def landmarks_capped(s, d):
    rows = bridge.rows(s, d)
    deg = graph.indegree(rows.select(F.col("row_pos").alias("key")), bridge.edges(s, d))
    papers = rows.join(deg, F.col("row_pos") == F.col("key")).select("ref", "family", (F.col("row_pos") % 5000 == 1).alias("is_lab"), "indegree", ranking.cites().alias("cites"))
    return ranking.landmarks(papers)


def year_midrank_cdf(s, d):
    return ranking.midrank_cdf(bridge.rows(s, d), "year").select(F.col("year").cast("bigint").alias("year"), "n", F.round("cdf", 6).alias("cdf"))


def warped_axis(s, d):
    return ranking.warped_axis(bridge.rows(s, d), "year", 0.5).select(F.col("year").cast("bigint").alias("year"), F.round("x", 6).alias("x"))


def family_topic_crosstab(s, d):
    return families.crosstab(bridge.rows(s, d), F.col("family"), F.col("topic"))


def family_balance(s, d):
    return families.balance(bridge.rows(s, d), F.col("family"))


# --- the same operators over the domain tables -------------------------------------------------
def xref_doi_frequency(s, d):
    e = table(s, d, "xref").select("slug", D.norm_doi(F.col("doi")).alias("doi"), "xref_id")
    return graph.citation_counts(e, "slug", "doi", "xref_id")


def xref_indegree(s, d):
    corpus = ranking.last_by_key(_rows(s, d).withColumn("key", D.norm_doi(F.col("doi"))).where("key is not null"), "key").select("key", "ref")
    e = table(s, d, "xref").select("slug", D.norm_doi(F.col("doi")).alias("doi")).where("doi is not null")
    cited = e.join(corpus, F.col("doi") == F.col("key")).select(F.col("slug").alias("citing"), F.col("ref").alias("cited")).distinct()
    return graph.indegree(_rows(s, d).select(F.col("ref").alias("key")).distinct(), cited)


def xref_backfilled(s, d):
    e = table(s, d, "xref").withColumn("d", D.norm_doi(F.col("doi"))).where("d is not null")
    first = e.groupBy("d").agg(F.min_by(F.struct("title", "year", "author", "journal"), "xref_id").alias("m"), F.count_distinct("slug").alias("n"))
    meta = _rows(s, d).withColumn("d", D.norm_doi(F.col("doi"))).where("d is not null").groupBy("d").agg(F.min_by(F.struct(F.col("title"), F.col("year").cast("string").alias("year"), A.lead_surname(F.col("apa")).alias("author"), F.col("venue").alias("journal")), "row_pos").alias("m"))
    return graph.backfill(first.select("d", "n", "m.*"), meta.select("d", "m.*"), "d").withColumnRenamed("d", "doi")


def top_refs_per_topic(s, d):
    top = ranking.top_per_group(_rows(s, d).where("topic is not null"), "topic", 10, ranking.cites(), "row_pos")
    return top.select("topic", "row_pos", ranking.cites().alias("cites"), F.col("rank").cast("bigint").alias("rank"))


def rows_last_wins(s, d):
    return ranking.last_by_key(_rows(s, d).where("ref is not null"), "ref").select("ref", "row_pos", "title")


def family_resolution(s, d):
    rows = ranking.first_by_key(_rows(s, d), "ref").where("family is not null").select("ref", F.col("family").alias("family_raw"))
    fams = _rows(s, d).where("trim(family) <> ''").groupBy(F.lower(F.trim("family")).alias("key")).agg(F.min("row_pos").alias("pos")).withColumn("name", F.upper("key"))
    return families.resolve(rows, fams).select("ref", "family_raw", "family")


def assignment_gate(s, d):
    rows = _rows(s, d).select("ref", "family")
    fams = rows.where("family is not null").groupBy("family").count().where("count >= 20").select(F.col("family").alias("key"))
    assigned = table(s, d, "citation_counts").select(F.col("key").alias("ref")).distinct().join(rows.where("family is not null").groupBy("ref").agg(F.min("family").alias("family")), "ref", "left").withColumn("family", F.coalesce("family", F.lit("none")))
    return families.violations(rows, assigned, fams)


def topic_codes(s, d):
    return families.topic_codes(_rows(s, d))


def family_digest(s, d):
    apa = F.coalesce("apa", F.lit(""))
    who = F.concat(A.lead_surname(apa), F.lit(" ("), F.coalesce(A.year_of(apa), F.lit(0)).cast("string"), F.lit(")"))
    line = F.concat_ws("\t", F.coalesce("ref", F.lit("")), F.coalesce("topic", F.lit("")), F.coalesce(F.col("cite_openalex").cast("string"), F.lit("")), who, F.left(F.coalesce("summary", F.lit("")), F.lit(240)))
    return _rows(s, d).select("row_pos", line.alias("line"))


def coverage(s, d):
    filled = lambda c: F.count_if(F.coalesce(F.trim(c), F.lit("")) != "").alias(f"n_{c}")
    return _rows(s, d).agg(F.count(F.lit(1)).alias("n"), *[filled(c) for c in ("doi", "arxiv", "pdf", "apa", "title", "family", "canonical_at")], F.count("cite_openalex").alias("n_openalex"), F.count("cite_s2").alias("n_s2"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.bool_or(F.col("cite_s2").isNotNull()).alias("has_cite"), F.count_if((F.col("summary") != F.col("title")) & (F.trim("summary") != "")).alias("n_abstract"), F.count_if(F.col("year") < FIRST_YEAR).alias("n_early"))


def source_tally(s, d):
    known = ["source-doc", "search", "xref", "lab", "anteced", "anteced-nosrc"]
    return _rows(s, d).groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.coalesce(F.col("source").isin(known), F.lit(False)))


# --- scalar functions over whole columns -------------------------------------------------------
def doi_normalize(s, d):
    return _rows(s, d).select("row_pos", D.doi_of(F.col("doi"), F.col("link")).alias("doi"), D.norm_doi(F.col("doi")).alias("comparable"))


def arxiv_ids(s, d):
    a = D.arxiv_id_of(F.col("arxiv"), F.col("doi"))
    return _rows(s, d).select("row_pos", D.norm_arxiv(a).alias("arxiv"), D.s2_id(a, D.doi_of(F.col("doi"), F.col("link"))).alias("s2"))


def parse_apa(s, d):
    return _rows(s, d).select("row_pos", A.parse_apa(F.col("apa")).alias("p")).select("row_pos", "p.*")


def split_apa(s, d):
    return _rows(s, d).select("row_pos", A.split_apa(F.col("apa")).alias("p")).where("p is not null").select("row_pos", "p.*")


def build_apa(s, d):
    none = F.lit(None).cast("string")
    whole = titles.build_apa(F.col("coauthors"), F.col("year"), F.col("title"), F.col("venue"), F.col("cite_openalex").cast("string"), F.col("type"), none)
    return _lab(s, d).select("row_pos", whole.alias("apa"))


def rows_appended(s, d):
    new = ranking.first_by_key(_lab(s, d).where("openalex is not null"), "openalex").select(F.concat(F.lit("work:"), F.col("openalex")).alias("ref"), "title", "year")
    return references.append(ranking.last_by_key(_rows(s, d).where("ref is not null"), "ref").select("ref", "title", "year"), new)


def lead_surname_year(s, d):
    return _rows(s, d).select("row_pos", A.lead_surname(F.col("apa")).alias("lead"), F.coalesce(A.year_of(F.col("apa")), F.lit(0)).alias("year"))


def split_names(s, d):
    n = _lab(s, d).select("row_pos", F.posexplode("coauthors").alias("pos", "name")).where("trim(name) <> ''")
    sp = names.split_name(F.col("name"))
    return n.select("row_pos", "pos", sp["family"].alias("family"), sp["given"].alias("given"), names.initials(sp["given"]).alias("initials"))


def format_authors(s, d):
    return _lab(s, d).select("row_pos", names.join_authors(F.col("coauthors")).alias("authors"))


def lab_references(s, d):
    return lab.paper_rows(_lab(s, d)).select("row_pos", "openalex", "doi", "link", "topic", "apa")


def lab_numbered(s, d):
    w = ranking.first_by_key(_lab(s, d), "openalex")
    return ranking.numbered(w, "label", F.coalesce("year", F.lit(0)), F.col("row_pos")).select("row_pos", "label")


def lab_dedup_first_wins(s, d):
    return ranking.first_by_key(_lab(s, d), "openalex").select("openalex", "row_pos", "title")


def lab_author_spans(s, d):
    n = _lab(s, d).select(F.explode("coauthors").alias("author"), "year").where("trim(author) <> ''")
    return lab.spans(n, "author", "year", 25)


def lab_detection(s, d):
    return _rows(s, d).select("row_pos", lab.is_lab(F.col("source"), F.col("apa"), ["Jeskuskamer", "Thruenzimer"]).alias("is_lab"))


def clean_venue(s, d):
    return _rows(s, d).select("row_pos", titles.clean_venue(F.col("venue")).alias("venue"))


def title_markup_strip(s, d):
    return _rows(s, d).where("title is not null").select("row_pos", F.trim(F.regexp_replace(titles.strip_markup(F.trim("title")), "[ \t\r\n]+", " ")).alias("title"))


def norm_titles(s, d):
    return _rows(s, d).select("row_pos", titles.norm_title(F.col("title")).alias("title"))


def fold_authors(s, d):
    return table(s, d, "openalex_authors").select("author_id", fold("display_name").alias("folded"))


def abstract_rebuild(s, d):
    docs = table(s, d, "documents").where("text <> ''").select("doc_id", F.split(F.trim(F.regexp_replace("text", r"[ \t\r\n]+", " ")), " ").alias("ws"))
    pos = docs.select("doc_id", F.posexplode("ws").alias("p", "w")).groupBy("doc_id", "w").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    inv = pos.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("inv"))
    return inv.select("doc_id", titles.unabstract(F.col("inv")).alias("text"))


def audit_findings(s, d):
    return references.findings(_rows(s, d))


def audit_summary(s, d):
    return references.summary(_rows(s, d))


def suspect_surnames(s, d):
    p = _rows(s, d).where("apa is not null").select("row_pos", F.explode(names.suspect_surnames(A.parse_apa(F.col("apa"))["authors"])).alias("surname"))
    return p


def repair_refs(s, d):
    return _rows(s, d).where("apa is not null").select("row_pos", audit.repair(F.col("apa")).alias("r")).select("row_pos", "r.fixed", F.array_join("r.changes", ",").alias("changes"))


def reference_list(s, d):
    return references.reference_list(_rows(s, d)).select("reference", "link", "first_pos")


def reference_order(s, d):
    return references.reference_list(_rows(s, d)).select("first_pos", "sort_key")


def cite_keys(s, d):
    return _rows(s, d).where("apa is not null").select("row_pos", F.explode(citekeys.keys_for(F.col("apa"))).alias("key"))


def cites_in_text(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.explode(citekeys.citations_in(F.col("text"))).alias("citation"))


def cite_resolution(s, d):
    return citecheck.resolve(table(s, d, "documents"), "text", _rows(s, d))


def pdf_dois(s, d):
    tail = F.regexp_replace(F.col("text"), r"(?is)^.*?\n(references|bibliography)[ \t]*\n", "")
    found = F.regexp_extract_all(tail, F.lit(r"(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)"), 1)
    return table(s, d, "documents").where("text is not null").select("doc_id", F.explode(F.array_distinct(F.transform(found, lambda x: F.lower(F.regexp_replace(x, r"[.,;)]+$", ""))))).alias("doi"))


# --- counts, verification, gates ---------------------------------------------------------------
def counts_max_wins(s, d):
    return counts.max_wins(table(s, d, "citation_counts"))


def counts_latest(s, d):
    return counts.latest(table(s, d, "citation_counts"))


def counts_reconciled(s, d):
    c = counts.max_wins(table(s, d, "citation_counts"))
    canon = _rows(s, d).where("ref is not null").groupBy(F.col("ref").alias("key")).agg(F.max("cite_openalex").alias("count"))
    return counts.reconciled(c, canon)


def attach_counts(s, d):
    return counts.attach(_rows(s, d), counts.max_wins(table(s, d, "citation_counts")), "ref").select("row_pos", "cite_openalex", "cite_s2", "updated")


def rows_to_citations(s, d):
    return verify.rows_to_citations(_rows(s, d))


def rows_to_papers(s, d):
    return verify.rows_to_papers(_rows(s, d))


def _sources(s, d):
    """Snapshots of three services, drawn from the other tables: every key was looked up; some are misses, some lookups fail, some hits disagree."""
    rows = ranking.first_by_key(_rows(s, d).withColumn("id", D.norm_doi(F.col("doi"))).where("id is not null"), "id")
    crossref = rows.select(
        "id", F.when(F.col("row_pos") % 7 == 0, "miss").when(F.col("row_pos") % 11 == 0, "transient").otherwise("hit").alias("status"), A.lead_surname(F.col("apa")).alias("first_author"),
        (F.col("year") + F.when(F.col("row_pos") % 5 == 0, 3).otherwise(0)).cast("string").alias("year"),
    )
    arxiv = ranking.first_by_key(_rows(s, d).where("arxiv <> ''"), "arxiv").select(
        F.col("arxiv").alias("id"), F.when(F.col("row_pos") % 3 == 0, "miss").otherwise("hit").alias("status"), F.coalesce("label", F.lit("")).alias("first_author"), F.col("year").cast("string").alias("year")
    )
    title = ranking.first_by_key(_lab(s, d).where("title <> ''"), "title").select(
        F.col("title").alias("id"), F.lit("hit").alias("status"), F.lit(None).cast("string").alias("first_author"), F.col("year").cast("string").alias("year")
    )
    return arxiv, crossref, title


def _report(s, d):
    arxiv, crossref, title = _sources(s, d)
    c = verify.rows_to_citations(_rows(s, d)).withColumn("doi", D.norm_doi(F.col("doi")))
    return verify.verify(c, [("arxiv", "arxiv", arxiv), ("doi", "doi", crossref), ("title", "title", title)])


def verify_verdicts(s, d):
    return _report(s, d).select("row_pos", "verdict", "source", F.array_join("issues", ",").alias("issues"))


def verify_tallies(s, d):
    return verify.tallies(_report(s, d))


def unique_key_gate(s, d):
    return references.repeated_keys(_rows(s, d), "ref")


def doi_collisions(s, d):
    return references.colliding_dois(_rows(s, d), "topic")


def dup_same_link(s, d):
    return duplicates.same_link(_rows(s, d))


def dup_similar_titles(s, d):
    return duplicates.similar_titles(_rows(s, d))


def _manifest(s, d):
    return ranking.first_by_key(_rows(s, d), "ref").select(F.col("ref").alias("slug"), "doi", "title", F.col("year").cast("string").alias("year"), A.lead_surname(F.col("apa")).alias("first_author"))


def filename_doi_match(s, d):
    files = _lab(s, d).where("doi <> ''").select(F.concat(F.regexp_replace(F.regexp_replace("doi", "^.*/", ""), r"\.", "_"), F.lit(".PDF")).alias("file"))
    more = _rows(s, d).where("pdf <> ''").select(F.col("pdf").alias("file"))
    return reconcile.filename_matches(files.union(more), _manifest(s, d))


def single_file_match(s, d):
    return reconcile.single_matches(filename_doi_match(s, d))


def text_signal_match(s, d):
    return reconcile.text_matches(table(s, d, "documents"), _manifest(s, d), "doc_id", "text")


def text_best_match(s, d):
    # the margin needs a page's two best
    return reconcile.best_with_margin(reconcile.text_matches(table(s, d, "documents"), _manifest(s, d), "doc_id", "text", best=2), "doc_id")


def slug_claims(s, d):
    m = text_best_match(s, d).where("slug is not null").select("doc_id", "slug")
    return reconcile.claim(m.join(table(s, d, "documents").select("doc_id", "added_at"), "doc_id"), "doc_id", "added_at").select("doc_id", "slug", "claimed")


def sentence_case_vocab(s, d):
    cased = titles.sentence_cased()
    t = _rows(s, d).where("title <> ''").select("row_pos", "title", cased(F.col("title")).alias("new"))
    pair = F.arrays_zip(F.split("title", " ").alias("old"), F.split("new", " ").alias("new"))
    w = t.select("row_pos", F.explode(pair).alias("p")).select("row_pos", "p.old", "p.new").where("old <> new")
    return w.groupBy("old", "new").agg(F.count(F.lit(1)).alias("n"), F.min("row_pos").alias("first_row"))


def beeswarm_layout(s, d):
    pts = ranking.last_by_key(_rows(s, d).where("ref is not null and year is not null and trim(family) <> ''"), "ref").select(F.lower(F.trim("family")).alias("family"), "ref", "year")
    return layout.beeswarm(pts, "family", "year", "ref")


def download_order(s, d):
    l = F.nullif("link", F.lit(""))
    c = lab.download_candidates(l, F.array(F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/"), F.col("ref")), l, F.concat(F.lit("https://arxiv.example/"), F.col("arxiv"))))
    return _rows(s, d).select("row_pos", F.array_join(c, " ").alias("urls"))


def canonical_source(s, d):
    return canonical.choose(_rows(s, d))


def html_text(s, d):
    docs = table(s, d, "documents").where("text is not null")
    return docs.select("doc_id", F.trim(F.regexp_replace(unescape(F.regexp_replace("text", r"<[^<>]+>", " ")), r"[ \t\r\n]+", " ")).alias("text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            internal_indegree, xref_frequency, xref_ranked_minus_exclude, top_cited_per_family, landmarks_capped, year_midrank_cdf, warped_axis, family_topic_crosstab, family_balance,
            xref_doi_frequency, xref_indegree, xref_backfilled, top_refs_per_topic, rows_last_wins, family_resolution, assignment_gate, topic_codes, family_digest, coverage, source_tally,
            doi_normalize, arxiv_ids, parse_apa, split_apa, build_apa, rows_appended, lead_surname_year, split_names, format_authors, lab_references, lab_numbered, lab_dedup_first_wins, lab_author_spans, lab_detection, clean_venue,
            title_markup_strip, norm_titles, fold_authors, abstract_rebuild, audit_findings, audit_summary, suspect_surnames, repair_refs, reference_list, reference_order, cite_keys, cites_in_text, cite_resolution, pdf_dois,
            counts_max_wins, counts_latest, counts_reconciled, attach_counts, rows_to_citations, rows_to_papers, verify_verdicts, verify_tallies, unique_key_gate, doi_collisions, dup_same_link, dup_similar_titles,
            filename_doi_match, single_file_match, text_signal_match, text_best_match, slug_claims, sentence_case_vocab, beeswarm_layout, download_order, canonical_source, html_text,
        )
    }
