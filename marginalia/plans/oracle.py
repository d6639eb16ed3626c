"""SQL counterparts of the core queries, over the same tables."""

from __future__ import annotations

from marginalia.plans.bridge import EDGES_SQL, rows_sql

_WS = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_HEAD = rf"(?s)^(.*?){_WS}?\((\p{{Nd}}{{4}})([a-z]?)\)\.?{_WS}*"
_TITLE = rf"(?s)^(.*?)([.?!])({_WS}.*)?$"
_MARKUP = r"</?[A-Za-z][A-Za-z0-9:._-]*(?:[\t-\r ][^>]*)?/?>"
_ROWS = f"rows as ({rows_sql('varchar')}), edges as ({EDGES_SQL})"
_DEG = "deg as (select r.row_pos as key, count(e.citing) as indegree from rows r left join edges e on e.cited = r.row_pos and e.citing <> e.cited group by 1)"
_CITES = "coalesce(greatest(cite_openalex, cite_s2), -1)"
_NORM = r"""nullif(trim(regexp_replace(regexp_replace(lower(trim(doi)), '^(https?://(dx\.)?doi\.(org|example)/|doi:)\s*', ''), '[.,;)\s]+$', '')), '')"""
_DOI_OF = r"regexp_replace(coalesce(nullif(trim(doi), ''), case when regexp_matches(link, '(?i)^https?://doi\.(org|example)/10\.') then link end), '(?i)^https?://doi\.(org|example)/', '')"
_ARXIV = r"coalesce(nullif(trim(arxiv), ''), nullif(regexp_extract(trim(doi), '(?i)10\.48550/arxiv\.(.+)$', 1), ''))"
_DIGITS = "translate({}, '０１２３４５６７８９', '0123456789')"
_YEAR = f"case when regexp_matches(apa, '{_HEAD}') then try_cast({_DIGITS.format(f"regexp_extract(apa, '{_HEAD}', 2)")} as int) end"
_AUTHORS = f"case when regexp_matches(apa, '{_HEAD}') then regexp_extract(apa, '{_HEAD}', 1) else coalesce(apa, '') end"
_LEAD = f"trim(split_part({_AUTHORS}, ',', 1))"
_PARSED = f"""
with h as (select row_pos, apa, doi, link, arxiv, regexp_matches(apa, '{_HEAD}') as ok, regexp_extract(apa, '{_HEAD}', 0) as head from paper_rows),
t as (select *, substring(apa, length(head) + 1) as tail from h),
e as (select *, regexp_matches(tail, '{_TITLE}') as ended from t),
p as (select row_pos, apa, doi, link, arxiv, ok,
  case when ok then regexp_extract(apa, '{_HEAD}', 1) end as authors,
  case when ok then try_cast({_DIGITS.format(f"regexp_extract(apa, '{_HEAD}', 2)")} as int) end as year,
  case when ok then regexp_extract(apa, '{_HEAD}', 3) end as suffix,
  case when ok then head end as head,
  case when ok then case when ended then regexp_extract(tail, '{_TITLE}', 1) else tail end end as title,
  case when ok then case when ended then regexp_extract(tail, '{_TITLE}', 2) else '' end end as terminal,
  case when ok then case when ended then regexp_extract(tail, '{_TITLE}', 3) else '' end end as rest
  from e)
"""
_FIRST = "select * from (select *, row_number() over (partition by {k} order by row_pos) as rn from {t}) where rn = 1"
_PARTS = "van|von|der|den|de|del|della|di|da|du|la|le|el|al|bin|ibn|dos|das|ten|ter|st"
_UP, _IN = "A-ZÀ-Ý", r"\p{L}\p{Nd}_À-ÿ''’\-"
_SURNAME = rf"([{_UP}][{_IN}]*(?:\s(?:[a-zà-ÿ]+\s)*[{_UP}][{_IN}]*)?),\s+(?:[{_UP}]\.(?:\s*[-{_UP}]\.)*)"
_NARR = rf"([{_UP}][{_IN}]+(?:\s(?:&|and)\s[{_UP}][{_IN}]+|\s+et\s+al\.)?\s+\(\d{{4}}[a-z]?\))"
_KEYS = f"""{_PARSED},
k as (select row_pos, concat(cast(year as varchar), suffix) as y, regexp_extract_all(authors, '{_SURNAME}', 1) as f from p where ok and apa is not null),
keys as (
  select row_pos, concat(f[1], ', ', y) as key from k where len(f) = 1
  union all select row_pos, concat(f[1], ' & ', f[2], ', ', y) from k where len(f) = 2
  union all select row_pos, concat(f[1], ' et al., ', y) from k where len(f) >= 2
  union all select row_pos, concat(f[1], ', ', f[2], ', et al., ', y) from k where len(f) >= 3
  union all select row_pos, concat(f[1], ', ', f[2], ', ', f[3], ', et al., ', y) from k where len(f) >= 3)"""
_CITED = rf"""
g as (select doc_id, text, unnest(regexp_extract_all(text, '\(([^()]*\d{{4}}[a-z]?[^()]*)\)', 1)) as g from documents where text is not null),
s as (select doc_id, regexp_replace(regexp_replace(trim(unnest(string_split(g, ';'))), ',+$', ''), ',\s*(?:p{{1,2}}\.|para\.|Ch\.)\s*[\d\-–]+$', '') as c from g),
nrr as (select doc_id, unnest(regexp_extract_all(text, '{_NARR}', 1)) as m from documents where text is not null),
cited as (
  select distinct doc_id, c as citation from s where regexp_matches(c, ',\s*\d{{4}}[a-z]?$')
  union select doc_id, concat(replace(regexp_extract(m, '^(.*?)\s+\(', 1), ' and ', ' & '), ', ', regexp_extract(m, '\((\d{{4}}[a-z]?)\)$', 1)) from nrr)"""
_FOLD = "trim(translate(lower(strip_accents({})), '’‘‐‑', '''''--'))"


def _letters_only(text: str) -> str:
    """SQL for the letters a to z of a text after compatibility decomposition, from Unicode's own data: characters for one letter, then ligatures."""
    import unicodedata

    plain = lambda o: "".join(c for c in unicodedata.normalize("NFKD", chr(o)) if not unicodedata.combining(c)).lower()
    one, more = {}, {}
    for o in (*range(0x80, 0x2C00), *range(0xFB00, 0xFB07), *range(0xFF00, 0xFFF0), *range(0x1D400, 0x1D800)):
        letters = "".join(c for c in plain(o) if "a" <= c <= "z")
        if letters and unicodedata.category(chr(o))[0] in "LSN":
            (one if len(letters) == 1 else more)[chr(o)] = letters
    sql = f"translate({text}, '{''.join(one)}', '{''.join(one.values())}')"
    for c in ("ﬀ", "ﬁ", "ﬂ", "ﬃ", "ﬄ", "ﬅ", "ﬆ", "Ĳ", "ĳ", "ﬆ", "™", "℠", "№", "℡"):
        sql = f"replace({sql}, '{c}', '{more[c]}')"
    return f"regexp_replace(lower(strip_accents({sql})), '[^a-z]', '', 'g')"


_SOURCE = f"(({_DOI_OF}) is not null or coalesce(arxiv, '') <> '')"
_RUN = r"""(select coalesce(max(c), 0) from (select count(*) as c from (
   select i, sum(case when big then 0 else 1 end) over (order by i) as grp, big from (
     select i, (upper(w) = w and length(w) >= 2) as big from (select unnest(ws) as w, generate_subscripts(ws, 1) as i))) where big group by grp))"""
_DEFECTS = rf"""{_PARSED},
q as (select row_pos, coalesce(apa, '') as apa, {_SOURCE} as src, ok, authors, coalesce(rest, '') as rest, coalesce(title, '') as title,
  regexp_extract_all(coalesce(title, ''), '([A-Za-z][A-Za-z''/-]*)', 1) as ws from p),
tok as (select row_pos, unnest(ws) as w, generate_subscripts(ws, 1) as i from q),
runs as (select row_pos, max(c) as run from (select row_pos, grp, count(*) as c from (
   select row_pos, big, sum(case when big then 0 else 1 end) over (partition by row_pos order by i) as grp from (select row_pos, i, upper(w) = w and length(w) >= 2 as big from tok)) where big group by 1, 2) group by 1),
d as (select q.*, coalesce(run, 0) as run from q left join runs using (row_pos)),
findings as (
  select row_pos, 'no-year' as finding from d where not coalesce(ok, false)
  union all select row_pos, 'no-authors' from d where starts_with(apa, 'Anon.') or authors = ''
  union all select row_pos, 'et-al' from d where contains(apa, ' et al')
  union all select row_pos, 'html-entity' from d where regexp_matches(apa, '&amp;|&#x|&lt;|&gt;')
  union all select row_pos, 'markup-tag' from d where regexp_matches(apa, '{_MARKUP}')
  union all select row_pos, 'double-terminal' from d where regexp_matches(apa, '[?!]\.')
  union all select row_pos, 'unicode-hyphen' from d where regexp_matches(apa, '[‐‑]')
  union all select row_pos, 'malformed-initial' from d where regexp_matches(apa, '\(\.|\[\.')
  union all select row_pos, 'replacement-char' from d where contains(apa, '�')
  union all select row_pos, 'single-letter-venue' from d where regexp_matches(apa, '\.{_WS}+[A-Z]\.{_WS}*$')
  union all select row_pos, 'uppercase-run' from d where run >= 3
  union all select row_pos, 'empty-venue' from d where src and regexp_replace(rest, '^[ .]+|[ .]+$', '', 'g') = '')"""
_SUSPECTS = rf"""x as (select row_pos, trim(regexp_replace(unnest(regexp_extract_all(authors, '(?:^|,[\t-\r ]|…[\t-\r ])([^,]+?),[\t-\r ]+(?:[A-ZÀ-Ý]\.)', 1)), '^[&…][\t-\r ]*', '')) as surname from p where ok and apa is not null),
sn as (select distinct row_pos, surname, list_filter(string_split_regex(surname, '{_WS}+'), lambda w: w <> '') as ws from x),
suspects as (select row_pos, surname from sn where len(ws) > 1 and len(list_filter(ws, lambda w: regexp_matches(lower(w), '^\.*({_PARTS})\.*$'))) = 0)"""
_AUDIT = f"""{_DEFECTS}, {_SUSPECTS},
notes as (select row_pos, 'no-source' as finding from d where not src union all select row_pos, concat('multi-word surname: ', surname) from suspects),
found as (select row_pos, 'defect' as level, finding from findings union all select row_pos, 'note', finding from notes)"""
_REPAIRED = rf"""
a as (select row_pos, apa, regexp_replace(apa, '{_MARKUP}', '', 'g') as a from paper_rows where apa is not null),
b as (select *, replace(replace(a, '‐', '-'), '‑', '-') as b from a),
f as (select *, trim(regexp_replace(regexp_replace(b, '([?!])\.({_WS}|$)', '\1\2', 'g'), '{_WS}{{2,}}', ' ', 'g')) as f,
  array_to_string(list_filter([case when regexp_matches(apa, '{_MARKUP}') then 'markup' end, case when regexp_matches(a, '[‐‑]') then 'hyphen' end, case when regexp_matches(b, '[?!]\.') then 'terminal' end], lambda x: x is not null), ',') as changes from b)"""
_AUTHOR_LIST = """a as (select row_pos, list_filter(coalesce(coauthors, []), lambda x: x is not null and x <> '' and x <> ',') as p from lab_papers),
authors as (select row_pos, case when len(p) = 0 then 'Anon.' when len(p) = 1 then p[1] when len(p) <= 20 then concat(array_to_string(p[1:len(p)-1], ', '), ', & ', p[len(p)])
  else concat(array_to_string(p[1:19], ', '), ', … ', p[len(p)]) end as authors from a)"""
_BESTCOUNT = 'best as (select key, max(openalex) as openalex, max(s2) as s2, max(s2_influential) as s2_influential, max("asof") as "asof" from citation_counts where key is not null group by 1)'
_CITATIONS = f"""{_PARSED},
c as (select r.row_pos, coalesce(r.ref, '?') as label, {_DOI_OF.replace('doi)', 'r.doi)').replace('link', 'r.link')} as doi, r.arxiv as arxiv, coalesce(p.title, '') as title,
  {_LEAD.replace('apa', 'r.apa')} as expect_first_author, coalesce(cast(p.year as varchar), '') as expect_year from paper_rows r join p using (row_pos))"""
_VERDICTS = f"""{_CITATIONS},
n as (select *, {_NORM} as nd from c),
rows1 as (select * from (select *, {_NORM} as id, row_number() over (partition by {_NORM} order by row_pos) as rn from paper_rows where {_NORM} is not null) where rn = 1),
cr as (select id, case when row_pos % 11 = 0 then 'transient' else 'hit' end as status, {_LEAD} as first_author, cast(year + case when row_pos % 5 = 0 then 3 else 0 end as varchar) as year from rows1 where row_pos % 7 <> 0),
ax as (select arxiv as id, 'hit' as status, coalesce(label, '') as first_author, cast(year as varchar) as year from ({_FIRST.format(k='arxiv', t="paper_rows where arxiv <> ''")}) where row_pos % 3 <> 0),
ti as (select title as id, 'hit' as status, null as first_author, cast(year as varchar) as year from ({_FIRST.format(k='title', t="lab_papers where title <> ''")})),
j as (select n.row_pos, n.expect_first_author as wa, n.expect_year as wy,
   case when ax.status = 'hit' then 'arxiv' when cr.status = 'hit' then 'doi' when ti.status = 'hit' then 'title' end as source,
   case when ax.status = 'hit' then ax.first_author when cr.status = 'hit' then cr.first_author when ti.status = 'hit' then ti.first_author end as fa,
   case when ax.status = 'hit' then ax.year when cr.status = 'hit' then cr.year when ti.status = 'hit' then ti.year end as fy,
   coalesce(cr.status = 'transient', false) as broken
   from n left join ax on n.arxiv = ax.id left join cr on n.nd = cr.id left join ti on n.title = ti.id),
l as (select *, lower(trim(coalesce(wa, ''))) as w, lower(trim(coalesce(fa, ''))) as g, trim(coalesce(fy, '')) as gy from j),
i as (select *, w <> '' and g <> '' and not contains(g, regexp_extract(w, '^\\S*')) and not contains(w, regexp_extract(g, '^\\S*')) as bad_a,
   regexp_matches(trim(wy), '^\\d+$') and regexp_matches(gy, '^\\d+$') and abs(try_cast(trim(wy) as bigint) - try_cast(gy as bigint)) > 1 as bad_y from l),
v as (select row_pos, case when source is null then case when broken then 'ERROR' else 'NOT-FOUND' end when bad_a or bad_y then 'MISMATCH' else 'OK' end as verdict, source,
   case when source is not null then concat(case when bad_a then 'first-author' else '' end, case when bad_a and bad_y then ',' else '' end, case when bad_y then 'year' else '' end) end as issues from i)"""
_NTEXT = r"trim(regexp_replace(regexp_replace(lower({}), '[^\p{{L}}\p{{M}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_SIGNALS = rf"""
with m as (select ref as slug, string_split_regex(lower({_LEAD}), '\s+')[1] as au, coalesce(cast(year as varchar), '') as yr,
   list_filter(string_split({_NTEXT.format("coalesce(title, '')")}, ' '), lambda w: length(w) >= 4 and not list_contains(['the','and','for','with','from','into','that','this','their','have','been','were','will','are','but'], w)) as words
   from ({_FIRST.format(k='ref', t='paper_rows')})),
pg as (select doc_id, substring(text, 1, 3000) as raw, {_NTEXT.format("substring(text, 1, 3000)")} as norm from documents where text is not null),
x as (select doc_id, slug, words, norm, au from pg join m on contains(norm, au) and (yr = '' or contains(raw, yr)) where au <> '' and len(words) >= 2),
h as (select doc_id, slug, norm, au, len(list_filter(words, lambda w: contains(norm, w))) as hits, len(words) as n from x),
sig as (select doc_id, slug, round(hits / n + case when instr(norm, au) - 1 < 1500 then 0.1 else 0.0 end, 6) as score from h where hits >= 2 and hits / n >= 0.25)"""
_BEST = """, best as (select doc_id, slug, score, lead(score) over w as nx, row_number() over w as rn from sig window w as (partition by doc_id order by score desc, slug)),
bm as (select doc_id, case when nx is null or round(score - nx, 6) >= 0.15 then slug end as slug, score, case when nx is null or round(score - nx, 6) >= 0.15 then 'match' else 'tie' end as decision from best where rn = 1)"""

_FILES = rf"""with f as (select distinct file from (select concat(replace(regexp_replace(doi, '^.*/', ''), '.', '_'), '.PDF') as file from lab_papers where doi <> '' union all select pdf from paper_rows where pdf <> '')),
st as (select file, regexp_replace(lower(regexp_extract(file, '[^/]*$')), '(.)\.[^.]*$', '\1') as s from f),
cs as (select file, s from st union select file, replace(s, '_', '-') from st union select file, replace(s, '_', '.') from st union select file, regexp_extract(s, '^(s\d{{5}}-\d+-\d+-\d+).*', 1) from st union select file, regexp_extract(s, '1-s2\.0-(s\d+)-main', 1) from st),
m as (select ref as slug, lower(doi) as d from ({_FIRST.format(k='ref', t='paper_rows')}) where coalesce(doi, '') <> ''),
sx as (select slug, case when contains(d, '/') then regexp_replace(d, '^[^/]*/', '') else d end as x from m),
pc as (select slug, x as p from sx union select slug, replace(x, '.', '_') from sx union select slug, unnest(regexp_extract_all(x, '([a-z]*\d{{3,}}[a-z\d\-_.]*)', 1)) from sx)
select distinct file, slug from (select * from cs where length(s) >= 4) c join (select * from pc where length(p) >= 4) q on contains(q.p, c.s) or contains(c.s, q.p)"""


def oracle_sql() -> dict[str, str]:
    return {
        "internal_indegree": f"with {_ROWS}, {_DEG} select key, indegree from deg",
        "xref_frequency": f"with {_ROWS} select cited, count(*) as n_citations, min(pos) as first_pos, string_agg(cast(citing as varchar), ',' order by pos, citing) as cited_by from edges group by 1",
        "xref_ranked_minus_exclude": f"with {_ROWS} select cited, count(*) as n_citations, min(pos) as first_pos, row_number() over (order by count(*) desc, min(pos)) as rank from edges where cited % 3 <> 0 group by 1 having count(*) >= 40",
        "top_cited_per_family": f"with {_ROWS}, r as (select family, ref, {_CITES} as cites, row_number() over (partition by family order by {_CITES} desc, row_pos) as rank from rows) select * from r where rank <= 4",
        "landmarks_capped": f"""with {_ROWS}, {_DEG},
p as (select ref, family, row_pos % 5000 = 1 as is_lab, indegree, {_CITES} as cites from rows join deg on key = row_pos),
r as (select *, row_number() over (partition by family order by cites desc, ref) as fr from p),
c as (select *, is_lab or fr <= 2 as kept from r where is_lab or indegree >= 3 or fr <= 4),
z as (select *, row_number() over (partition by kept order by indegree desc, cites desc, ref) as pr, count(*) over () as n_all, count_if(kept) over () as n_kept from c)
select ref, family, is_lab, indegree, cites, n_all > 28 as capped from z where n_all <= 28 or kept or pr <= 28 - n_kept""",
        "year_midrank_cdf": f"with {_ROWS}, y as (select year, count(*) as n from rows where year is not null group by 1) select year, n, round((2 * sum(n) over (order by year) - n) / 2.0 / sum(n) over (), 6) as cdf from y",
        "warped_axis": f"""with {_ROWS}, y as (select year, count(*) as n from rows where year is not null group by 1),
c as (select year, n, (2 * sum(n) over (order by year) - n) / 2.0 / sum(n) over () as cdf from y), s as (select min(year) - 3 as lo, max(year) + 2 as hi from c)
select year, round(0.5 * (year - lo) / (hi - lo) + 0.5 * cdf, 6) as x from c, s""",
        "family_topic_crosstab": f"with {_ROWS}, c as (select family, topic, count(*) as n from rows group by 1, 2) select *, cast(sum(n) over (partition by family) as bigint) as family_total from c",
        "family_balance": f"with {_ROWS}, c as (select family, count(*) as n from rows group by 1) select family, n, round(n / sum(n) over (), 6) as share, case when n = 0 then 'empty' when n = 1 then 'singleton' when n / sum(n) over () > 0.6 then 'dominant' end as warning from c",
        "xref_doi_frequency": f"with e as (select {_NORM} as doi, slug, xref_id from xref) select doi, count(distinct coalesce(slug, '\x01')) as n_citations, min(xref_id) as first_pos from e where doi is not null group by 1",
        "xref_indegree": f"""with k as (select {_NORM} as key, ref, row_pos from paper_rows), c as (select key, max_by(ref, row_pos) as ref from k where key is not null group by 1),
e as (select distinct slug, c.ref as cited from (select slug, {_NORM} as doi from xref) x join c on x.doi = c.key)
select r.ref as key, count(e.slug) as indegree from (select distinct ref from paper_rows) r left join e on e.cited = r.ref and e.slug <> e.cited group by 1""",
        "top_refs_per_topic": f"with r as (select topic, row_pos, {_CITES} as cites, row_number() over (partition by topic order by {_CITES} desc, row_pos) as rank from paper_rows where topic is not null) select * from r where rank <= 10",
        "rows_last_wins": "select ref, row_pos, title from (select *, row_number() over (partition by ref order by row_pos desc) as rn from paper_rows where ref is not null) where rn = 1",
        "family_resolution": f"""with f as (select lower(trim(family)) as key from paper_rows where trim(family) <> '' group by 1)
select ref, family as family_raw, coalesce(f.key, family) as family from ({_FIRST.format(k='ref', t='paper_rows')}) r left join f on f.key = lower(trim(r.family)) where family is not null""",
        "assignment_gate": """with fams as (select family as key from paper_rows where family is not null group by 1 having count(*) >= 20),
f1 as (select ref, min(family) as family from paper_rows where family is not null group by 1),
a as (select k.ref, coalesce(f1.family, 'none') as family from (select distinct key as ref from citation_counts) k left join f1 using (ref))
select 2 as step, 'family-count' as gate, cast(count(*) as varchar) as item from fams having count(*) < 2 or count(*) > 9
union all select 3, 'missing', ref from (select distinct ref from paper_rows) where ref not in (select ref from a where ref is not null)
union all select 4, 'extra', ref from (select distinct ref from a) where ref not in (select ref from paper_rows where ref is not null)
union all select 5, 'unknown-key', family from (select distinct family from a) where family not in (select key from fams)""",
        "topic_codes": r"""with t as (select distinct topic from paper_rows where topic is not null),
b as (select topic, case when regexp_matches(topic, '^\s*[A-Za-z0-9]+[.)]') then regexp_extract(topic, '^\s*([A-Za-z0-9]+)[.)]', 1)
   else coalesce(nullif(substring(regexp_replace(coalesce(regexp_extract(topic, '\S+'), '?'), '[^A-Za-z0-9]+', '', 'g'), 1, 4), ''), '?') end as base from t),
n as (select *, row_number() over (partition by base order by topic) as n from b) select topic, concat(base, case when n > 1 then cast(n as varchar) else '' end) as code from n""",
        "canonical_source": rf"""with a as (select row_pos, {_DOI_OF} as d, regexp_replace(trim({_ARXIV}), 'v\d+$', '') as a from paper_rows),
s as (select *, case when d is not null and not regexp_matches(d, '(?i)10\.48550/arxiv\.') then 'crossref' when a is not null then 'arxiv' end as source from a)
select row_pos, source, case source when 'crossref' then lower(d) when 'arxiv' then a end as id from s""",
        "family_digest": f"select row_pos, concat_ws(chr(9), coalesce(ref, ''), coalesce(topic, ''), coalesce(cast(cite_openalex as varchar), ''), concat({_LEAD}, ' (', cast(coalesce({_YEAR}, 0) as varchar), ')'), substring(coalesce(summary, ''), 1, 240)) as line from paper_rows",
        "coverage": "select count(*) as n, "
        + ", ".join(f"count_if(coalesce(trim({c}), '') <> '') as n_{c}" for c in ("doi", "arxiv", "pdf", "apa", "title", "family", "canonical_at"))
        + ", count(cite_openalex) as n_openalex, count(cite_s2) as n_s2, min(year) as first_year, max(year) as last_year, bool_or(cite_s2 is not null) as has_cite, count_if(summary <> title and trim(summary) <> '') as n_abstract, count_if(year < 1990) as n_early from paper_rows",
        "source_tally": "select source, count(*) as n, coalesce(source in ('source-doc', 'search', 'xref', 'lab', 'anteced', 'anteced-nosrc'), false) as known from paper_rows group by source",
        "doi_normalize": f"select row_pos, {_DOI_OF} as doi, {_NORM} as comparable from paper_rows",
        "arxiv_ids": rf"with a as (select row_pos, {_ARXIV} as a, {_DOI_OF} as d from paper_rows) select row_pos, regexp_replace(trim(a), 'v\d+$', '') as arxiv, case when a is not null then concat('ARXIV:', regexp_replace(trim(a), 'v\d+$', '')) when d is not null then concat('DOI:', d) end as s2 from a",
        "parse_apa": f"{_PARSED} select row_pos, authors, year, suffix, head, title, terminal, rest from p",
        "split_apa": f"{_PARSED} select row_pos, head, concat(title, terminal) as title, rest from p where terminal <> '' and rest <> ''",
        "build_apa": rf"""with {_AUTHOR_LIST},
t as (select row_pos, authors, year, coalesce(title, '') as title, coalesce(venue, '') as venue, cast(cite_openalex as varchar) as v, nullif(type, '') as i from authors join lab_papers using (row_pos))
select row_pos, translate(regexp_replace(concat(authors, ' (', coalesce(cast(year as varchar), 'n.d.'), '). ', title, case when regexp_matches(title, '[?!]$') then '' else '.' end,
  case when venue <> '' then concat(' ', venue, case when v is not null then concat(', ', v, coalesce('(' || i || ')', '')) else '' end, '.') else '' end), '{_MARKUP}', '', 'g'), '‐‑', '--') as apa from t""",
        "rows_appended": f"""select ref, title, year from (select *, row_number() over (partition by ref order by row_pos desc) as rn from paper_rows where ref is not null) where rn = 1
union all select concat('work:', openalex), title, year from ({_FIRST.format(k='openalex', t='lab_papers where openalex is not null')})""",
        "single_file_match": f"with m as ({_FILES}) select file, min(slug) as slug from m group by 1 having count(*) = 1",
        "lead_surname_year": f"select row_pos, {_LEAD} as lead, coalesce({_YEAR}, 0) as year from paper_rows",
        "format_authors": f"with {_AUTHOR_LIST} select row_pos, authors from authors",
        "split_names": rf"""with n as (select row_pos, unnest(coauthors) as name, generate_subscripts(coauthors, 1) - 1 as pos from lab_papers),
t as (select row_pos, cast(pos as int) as pos, trim(regexp_replace(name, '{_WS}+', ' ', 'g')) as x from n where trim(name) <> ''),
s as (select row_pos, pos, case when contains(x, ' ') then regexp_extract(x, '^(\S+(?: \S+)*?)((?: \.*(?i:{_PARTS})\.*)* \S+)$', 1) else '' end as given, x from t),
g as (select *, trim(substring(x, length(given) + 1)) as family, regexp_replace(regexp_replace(given, '[()\[\].]', ' ', 'g'), '{_WS}+', ' ', 'g') as clean from s)
select row_pos, pos, family, given, array_to_string(list_transform(list_filter(string_split(clean, ' '), lambda w: w <> ''),
   lambda w: array_to_string(list_transform(list_filter(string_split(w, '-'), lambda q: q <> ''), lambda q: concat(upper(substring(q, 1, 1)), '.')), '-')), ' ') as initials from g""",
        "lab_dedup_first_wins": f"select openalex, row_pos, title from ({_FIRST.format(k='openalex', t='lab_papers')}) union all select null, row_pos, title from lab_papers where false",
        "lab_numbered": f"select row_pos, concat('L', cast(row_number() over (order by coalesce(year, 0), row_pos) as varchar)) as label from ({_FIRST.format(k='openalex', t='lab_papers')})",
        "lab_author_spans": "with n as (select unnest(coauthors) as author, year from lab_papers) select author, count(*) as works, min(year) as first, max(year) as last, max(year) - min(year) > 25 as merged from n where trim(author) <> '' and year is not null group by 1",
        "lab_detection": r"select row_pos, coalesce(source, '') = 'lab' or regexp_matches(concat(' ', split_part(coalesce(apa, ''), '(', 1), ' '), '(?i)[^\p{L}\p{M}\p{Nd}_](Jeskuskamer|Thruenzimer)[^\p{L}\p{M}\p{Nd}_]') as is_lab from paper_rows",
        "clean_venue": rf"select row_pos, regexp_replace(trim(coalesce(venue, '')), '{_WS}*\([^)]*\){_WS}*$', '') as venue from paper_rows",
        "title_markup_strip": rf"select row_pos, trim(regexp_replace(regexp_replace(trim(title), '{_MARKUP}', '', 'g'), '[ \t\r\n]+', ' ', 'g')) as title from paper_rows where title is not null",
        "fold_authors": f"select author_id, {_FOLD.format('display_name')} as folded from openalex_authors",
        "abstract_rebuild": r"select doc_id, trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')) as text from documents where text <> ''",
        "audit_findings": f"{_AUDIT} select row_pos, level, finding from found",
        "repair_refs": f"with {_REPAIRED.strip()} select row_pos, case when changes <> '' then f else apa end as fixed, changes from f",
        "audit_summary": f"""{_AUDIT}, {_REPAIRED.strip()}
select (select count(*) from paper_rows) as n_rows, (select count(distinct row_pos) from findings) as n_defective, (select count(*) from findings) as n_defects,
  (select count(distinct row_pos) from notes) as n_noted, (select count(*) from f where changes <> '') as n_repairable, (select count_if(coalesce(canonical_at, '') <> '') from paper_rows) as n_canonical""",
        "reference_list": "with r as (select trim(apa) as a, min_by(link, row_pos) as link, min(row_pos) as first_pos from paper_rows where coalesce(trim(apa), '') <> '' group by 1) select case when regexp_matches(a, '[.?!]$') then a else concat(a, '.') end as reference, link, first_pos from r",
        "reference_order": f"with r as (select trim(apa) as a, min(row_pos) as first_pos from paper_rows where coalesce(trim(apa), '') <> '' group by 1) select first_pos, {_letters_only('a')} as sort_key from r",
        "suspect_surnames": f"{_PARSED}, {_SUSPECTS} select row_pos, surname from suspects",
        "cite_keys": f"{_KEYS} select row_pos, key from keys",
        "cites_in_text": f"with {_CITED.strip()} select doc_id, citation from cited",
        "cite_resolution": f"""{_KEYS}, {_CITED.strip()},
kf as (select distinct {_FOLD.format('key')} as k, ref from keys join paper_rows using (row_pos)), kn as (select k, count(*) as n_refs, min(ref) as first_ref from kf group by 1)
select citation, case when n_refs is null then 'unresolved' when n_refs > 1 then 'ambiguous' else 'ok' end as status, coalesce(n_refs, 0) as n_refs, first_ref from (select distinct citation from cited) c left join kn on kn.k = {_FOLD.format('citation')}""",
        "pdf_dois": r"""with t as (select doc_id, regexp_replace(text, '(?is)^.*?\n(references|bibliography)[ \t]*\n', '') as t from documents where text is not null),
x as (select doc_id, unnest(regexp_extract_all(t, '(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)', 1)) as d from t) select distinct doc_id, lower(regexp_replace(d, '[.,;)]+$', '')) as doi from x""",
        "counts_max_wins": f"with {_BESTCOUNT} select * from best",
        "counts_latest": """select key, openalex, s2, "asof" from (select *, row_number() over (partition by key order by "asof" desc nulls last, loaded_at desc nulls last, coalesce(openalex, -1) desc, coalesce(s2, -1) desc) as rn from citation_counts where key is not null) where rn = 1""",
        "counts_reconciled": f"""with {_BESTCOUNT}, c as (select ref as key, max(cite_openalex) as n from paper_rows where ref is not null group by 1)
select key, case when s2 >= 50 and openalex < 0.5 * s2 then greatest(openalex, n) else coalesce(openalex, n) end as openalex, s2, coalesce(s2 >= 50 and openalex < 0.5 * s2 and n > openalex, false) as corrected from best left join c using (key)""",
        "attach_counts": f"with {_BESTCOUNT} select row_pos, coalesce(best.openalex, r.cite_openalex) as cite_openalex, coalesce(best.s2, r.cite_s2) as cite_s2, best.key is not null as updated from paper_rows r left join best on best.key = r.ref",
        "rows_to_citations": f"{_CITATIONS} select * from c",
        "rows_to_papers": f"select row_pos, ref as slug, {_DOI_OF} as doi, nullif(pdf, '') as pdf from paper_rows where ({_DOI_OF}) is not null or coalesce(pdf, '') <> ''",
        "verify_verdicts": f"{_VERDICTS} select row_pos, verdict, source, issues from v",
        "verify_tallies": f"{_VERDICTS} select count_if(verdict = 'OK') as n_ok, count_if(verdict = 'MISMATCH') as n_mismatch, count_if(verdict = 'NOT-FOUND') as n_not_found, count_if(verdict = 'ERROR') as n_error from v",
        "unique_key_gate": "select ref, count(*) as n from paper_rows where ref is not null group by 1 having count(*) > 1",
        "doi_collisions": f"select lower({_DOI_OF}) as doi, count(*) as n_rows, count(distinct topic) as n_groups from paper_rows where ({_DOI_OF}) is not null group by 1 having count(*) > 1",
        "dup_same_link": "with r as (select row_pos, lower(trim(link)) as l from paper_rows where coalesce(trim(link), '') <> '') select x.row_pos as a, y.row_pos as b, cast(1.0 as double) as ratio, 'same DOI' as reason from r x join r y on x.l = y.l and x.row_pos < y.row_pos",
        "filename_doi_match": _FILES,
        "text_signal_match": f"{_SIGNALS} select * from sig",
        "text_best_match": f"{_SIGNALS}{_BEST} select doc_id, slug, score, decision from bm",
        "slug_claims": f"{_SIGNALS}{_BEST} select doc_id, slug, row_number() over (partition by slug order by added_at desc, doc_id) = 1 as claimed from bm join documents using (doc_id) where slug is not null",
        "download_order": r"""with u as (select row_pos, list_filter([nullif(link, ''), concat('https://pmc.ncbi.nlm.nih.gov/', ref), case when arxiv is not null then concat('https://arxiv.example/', arxiv) end], lambda x: x is not null) as u from paper_rows)
select row_pos, array_to_string(list_concat(list_filter(u, lambda x: not regexp_matches(lower(x), 'ncbi\.nlm\.nih\.gov|europepmc')), list_filter(u, lambda x: regexp_matches(lower(x), 'ncbi\.nlm\.nih\.gov|europepmc'))), ' ') as urls from u""",
        "xref_backfilled": f"""with e as (select *, {_NORM} as d from xref), f as (select d, min_by({{'title': title, 'year': year, 'author': author, 'journal': journal}}, xref_id) as m, count(distinct slug) as n from e where d is not null group by 1),
r as (select *, {_NORM} as d, {_LEAD} as lead from paper_rows), k as (select d, min_by({{'title': title, 'year': cast(year as varchar), 'author': lead, 'journal': venue}}, row_pos) as m from r where d is not null group by 1)
select d as doi, n, case when b then k.m.title else f.m.title end as title, case when b then k.m.year else f.m.year end as year, case when b then k.m.author else f.m.author end as author, case when b then k.m.journal else f.m.journal end as journal
from (select f.d, f.n, f.m, k.m as km, coalesce(f.m.title, '') = '' and k.m.title is not null as b from f left join k using (d)) z, lateral (select z.m as m) f, lateral (select z.km as m) k""",
    }
