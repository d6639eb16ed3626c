"""SQL counterparts of the pN_ queries, where SQL can express them over the whole tables."""

from __future__ import annotations

_DOI = r"""nullif(trim(regexp_replace(regexp_replace(lower(trim(doi)), '^(https?://(dx\.)?doi\.(org|example)/|doi:)\s*', ''), '[.,;)\s]+$', '')), '')"""

_TOP = """
with items as (
  select lower(trim(family)) as family, ref, min(row_pos) as row_pos from paper_rows
  where lower(trim(family)) <> '' and ref is not null group by 1, 2),
best as (select key as ref, max(greatest(openalex, s2)) as score from citation_counts where key is not null group by 1),
ranked as (
  select family, ref, coalesce(score, -1) as score, row_pos,
         row_number() over (partition by family order by coalesce(score, -1) desc, row_pos, ref) as rank
  from items left join best using (ref))
"""

_FREQ = f"""
with e as (select {_DOI} as doi, slug from xref),
n as (select count(distinct slug) as total from xref),
f as (select doi, count(distinct slug) as records, count(*) as entries from e where doi is not null group by doi),
m as (select doi, records, entries,
             case when records = 0 then null when records <= 1 then 'rare' when records > 0.02 * total then 'common' end as mark
      from f, n)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _TOP + "select family, ref from ranked where rank <= 5",
        "p1_ranked": _TOP + "select family, ref, score, row_pos, rank from ranked where rank <= 5",
        "p2_found": _FREQ + "select doi, mark from m where mark is not null",
        "p2_frequencies": _FREQ + "select doi, records, entries, mark from m",
    }
