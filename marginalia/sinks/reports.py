"""Reports for people: spreadsheet, Markdown, document and figure, written with the standard library."""

from __future__ import annotations

import html
import json
import zipfile
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.layout import place_labels, ticks
from marginalia.sinks.tables import bounded

COLUMNS = ["ref", "topic", "apa", "link", "summary", "tag", "pdf", "xref"]
#: Fill of a row by its source; an unknown source gets the last.
FILLS = {"source-doc": "FFFFFF", "search": "E8F1FB", "xref": "EAF6EA", "lab": "FFF4D6", "anteced": "F3EAF7", "anteced-nosrc": "F7E6E6", "": "EEEEEE"}


def sheet_table(rows: DataFrame) -> DataFrame:
    """The columns of the sheet: after ``tag`` come family and counts, each only if any row carries one."""
    has = rows.agg(F.bool_or(F.coalesce(F.trim("family"), F.lit("")) != "").alias("f"), F.bool_or(F.col("cite_openalex").isNotNull() | F.col("cite_s2").isNotNull()).alias("c")).head()
    at = COLUMNS.index("tag") + 1
    extra = (["family"] if has["f"] else []) + (["cite"] if has["c"] else [])
    cite = F.greatest("cite_openalex", "cite_s2").alias("cite")
    return rows.orderBy("row_pos").select(*[cite if c == "cite" else F.col(c) for c in COLUMNS[:at] + extra + COLUMNS[at:]], F.coalesce("source", F.lit("")).alias("_source"))


def _letters(i: int) -> str:
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


def _cell(value, at: str, style: int) -> str:
    if value is None or value == "":
        return f'<c r="{at}" s="{style}"/>'
    if isinstance(value, int) and not isinstance(value, bool):
        return f'<c r="{at}" s="{style}"><v>{value}</v></c>'
    clean = "".join(c for c in str(value) if c >= " " or c in "\t\n\r")
    return f'<c r="{at}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{html.escape(clean)}</t></is></c>'


def spreadsheet(rows: DataFrame, path: str) -> int:
    """Write the bounded table of papers as an .xlsx workbook: frozen header, rows coloured by source, links as links; the number of rows."""
    data = bounded(sheet_table(rows))
    cols = [c for c in (data[0] if data else dict.fromkeys(COLUMNS)) if c != "_source"]
    fills = list(FILLS)
    lines = ['<row r="1">' + "".join(_cell(c.capitalize(), f"{_letters(i)}1", 0) for i, c in enumerate(cols)) + "</row>"]
    links, rels = [], []
    for n, r in enumerate(data, 2):
        style = fills.index(r["_source"]) + 1 if r["_source"] in FILLS else len(fills)
        lines.append(f'<row r="{n}" ht="110" customHeight="1">' + "".join(_cell(r[c], f"{_letters(i)}{n}", style) for i, c in enumerate(cols)) + "</row>")
        if r.get("link"):
            links.append(f'<hyperlink ref="{_letters(cols.index("link"))}{n}" r:id="L{n}"/>')
            rels.append(f'<Relationship Id="L{n}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/hyperlink" Target="{html.escape(r["link"])}" TargetMode="External"/>')
    main, doc = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack, ctype = "http://schemas.openxmlformats.org/package/2006", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    pattern = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="FF{c}"/></patternFill></fill>' for c in FILLS.values())
    xfs = '<xf fillId="0"/>' + "".join(f'<xf fillId="{i + 2}" applyFill="1" applyAlignment="1"><alignment wrapText="1" vertical="top"/></xf>' for i in range(len(FILLS)))
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{ctype}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{ctype}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{ctype}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="{doc}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{doc}"><sheets><sheet name="Papers" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="{doc}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{doc}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="1"><font/></fonts><fills count="{len(FILLS) + 2}"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{pattern}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{len(FILLS) + 1}">{xfs}</cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}" xmlns:r="{doc}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><sheetData>{"".join(lines)}</sheetData>' + (f"<hyperlinks>{''.join(links)}</hyperlinks>" if links else "") + "</worksheet>",
        "xl/worksheets/_rels/sheet1.xml.rels": f'<Relationships xmlns="{pack}/relationships">{"".join(rels)}</Relationships>',
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, head + body)
    return len(data)


def _md(x) -> str:
    return "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")


def markdown_table(header: Iterable[str], rows: Iterable[Iterable]) -> str:
    """A Markdown table; NULL cells are blank."""
    head = [str(h) for h in header]
    return "\n".join(["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(map(_md, r)) + " |" for r in rows)])


def families_markdown(cells: DataFrame, codes: DataFrame, members: DataFrame) -> str:
    """The families' report: cross-tabulation by topic codes, legend, and the members of each family by year and ref.

    ``cells`` has family, topic, n; ``codes`` topic, code; ``members`` family, ref, year, apa.
    """
    code = {r["topic"]: r["code"] for r in bounded(codes, 1000)}
    grid: dict[str, dict[str, int]] = {}
    for r in bounded(cells, 50_000):
        grid.setdefault(r["family"], {})[code.get(r["topic"], "?")] = r["n"]
    marks = [code[t] for t in sorted(code)]
    out = [markdown_table(["Family", *marks, "Total"], ([f, *(grid[f].get(m) for m in marks), sum(grid[f].values())] for f in sorted(grid))), ""]
    out += [f"- **{code[t]}** {t}" for t in sorted(code)]
    rows = sorted(bounded(members.select("family", "ref", F.coalesce("year", F.lit(0)).alias("year"), "apa")), key=lambda r: (r["family"], r["year"], r["ref"]))
    for fam in sorted({r["family"] for r in rows}):
        out += ["", f"## {fam}", "", markdown_table(["Ref", "Year", "Reference"], ([r["ref"], r["year"] or "", r["apa"]] for r in rows if r["family"] == fam))]
    return "\n".join(out) + "\n"


def figure(
    points: DataFrame, lanes: list[str], width: int = 1560, lane_height: int = 140, axis: dict[int, float] | None = None, warped: bool = False,
    arrows: list[tuple[str, str, str, str]] = (), emphasis: frozenset[str] = frozenset(),
) -> str:
    """A standalone SVG of dots: ``points`` has family, x (0 to 1), offset, ref, label (NULL for small dots); raises if no point lies in a lane.

    ``axis`` gives the places of years (those between are interpolated), of which the thinned ticks are drawn; ``arrows`` are (from, to, colour, label), left out if an
    end isn't drawn; the refs in ``emphasis`` are ringed. Labels take the first free tier.
    """
    left, top, plot = 270, 112, width - 330
    height = max(660, 150 + lane_height * len(lanes))
    step = (height - top - 56) / max(1, len(lanes))
    drawn = [p for p in bounded(points) if p["family"] in lanes]
    if not drawn:
        raise ValueError("nothing to plot: no point lies in a lane")
    place = {p["ref"]: (left + p["x"] * plot, top + (lanes.index(p["family"]) + 0.5) * step + p["offset"]) for p in drawn}
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} {height}" font-family="sans-serif" font-size="12">']
    if axis:
        years = sorted(axis)
        at = lambda year: left + float(np.interp(year, years, [axis[y] for y in years])) * plot
        for year in ticks(min(axis), max(axis), at, warped):
            out.append(f'<text x="{at(year):.1f}" y="{height - 20}" text-anchor="middle">{year}</text><line x1="{at(year):.1f}" x2="{at(year):.1f}" y1="{top}" y2="{height - 40}" stroke="#eee"/>')
    for i, lane in enumerate(lanes):
        y = top + (i + 0.5) * step
        out.append(f'<text x="12" y="{y:.1f}">{html.escape(lane)}</text><line x1="{left}" x2="{left + plot}" y1="{y:.1f}" y2="{y:.1f}" stroke="#ddd"/>')
    for a, b, color, label in arrows:
        if a in place and b in place:
            (x1, y1), (x2, y2) = place[a], place[b]
            out.append(f'<path d="M{x1:.1f},{y1:.1f} Q{(x1 + x2) / 2:.1f},{min(y1, y2) - 30:.1f} {x2:.1f},{y2:.1f}" fill="none" stroke="{html.escape(color)}"><title>{html.escape(label)}</title></path>')
    drawn.sort(key=lambda r: (lanes.index(r["family"]), r["x"], r["ref"]))
    big = [p for p in drawn if p["label"]]
    tiers = dict(zip((p["ref"] for p in big), place_labels([(*place[p["ref"]], p["label"]) for p in big])))
    for p in drawn:
        x, y = place[p["ref"]]
        marked = f' stroke="#c00" stroke-width="2"' if emphasis and p["ref"] in emphasis else ""
        out.append(f'<circle data-ref="{html.escape(p["ref"])}" cx="{x:.1f}" cy="{y:.1f}" r="{7 if p["label"] else 2.7}"{marked}><title>{html.escape(p["ref"])}</title></circle>')
        if p["label"]:
            out.append(f'<text x="{x:.1f}" y="{y + tiers[p["ref"]]:.1f}" text-anchor="middle">{html.escape(p["label"])}</text>')
    return "".join([*out, "</svg>"])


#: A click on a dot shows its row.
_CARD = (
    "document.addEventListener('DOMContentLoaded',()=>{const rows=new Map(JSON.parse(document.getElementById('data').textContent).map(r=>[String(r.ref),r])),card=document.getElementById('card');"
    "document.addEventListener('click',e=>{const c=e.target.closest('circle');card.textContent=c&&rows.has(c.dataset.ref)?Object.entries(rows.get(c.dataset.ref)).map(p=>p.join(': ')).join('\\n'):'';});});"
)


def page(svg: str, data: list[dict], title: str) -> str:
    """An HTML page with the figure and its data; the data can't close the script element."""
    safe = json.dumps(data, ensure_ascii=False, default=str).replace("</", "<\\/")
    return f'<!doctype html><meta charset="utf-8"><title>{html.escape(title)}</title>{svg}<div id="card"></div><script>{_CARD}</script><script type="application/json" id="data">{safe}</script>'


def document(content: dict, references: list[str], path: str) -> None:
    """A .docx review: title, authors, abstract, sections with paragraphs, reference list."""
    para = lambda text, style="": f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>' if style else ''}<w:r><w:t xml:space=\"preserve\">{html.escape(text)}</w:t></w:r></w:p>"
    who = content.get("authors") or []
    names = who[0] if len(who) == 1 else f"{who[0]} and {who[1]}" if len(who) == 2 else ", ".join(who[:-1]) + f", and {who[-1]}" if who else ""
    body = [para(content.get("title", ""), "Title"), para(names)]
    if content.get("abstract"):
        body += [para("Abstract", "Heading1"), para(content["abstract"])]
    for s in content.get("sections") or []:
        body += [para(s["heading"], f"Heading{s.get('level', 1)}"), *map(para, s.get("paragraphs") or [])]
    body += [para(content.get("references_heading", "References"), "Heading1"), *map(para, references)]
    ns, pack = "http://schemas.openxmlformats.org/wordprocessingml/2006/main", "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>')
        z.writestr("word/document.xml", f'<w:document xmlns:w="{ns}"><w:body>{"".join(body)}</w:body></w:document>')
