"""An index of this package's modules, kept between two marks of a text."""

from __future__ import annotations

import ast
import base64
import textwrap
from pathlib import Path

BEGIN, END = "<!-- index: begin -->", "<!-- index: end -->"


def purpose(source: str) -> str:
    """The first sentence of a module's docstring."""
    words = " ".join((ast.get_docstring(ast.parse(source)) or "").split("\n\n")[0].split())
    for i, c in enumerate(words):
        if c in ".!?" and (i + 1 == len(words) or words[i + 1] == " "):
            return words[: i + 1]
    return words


def index(folder: str) -> str:
    """A Markdown table of the modules below a folder with their purposes."""
    from marginalia.sinks.reports import markdown_table

    root = Path(folder)
    return markdown_table(["Module", "Purpose"], ([f"`{p.relative_to(root)}`", purpose(p.read_text(encoding="utf-8"))] for p in sorted(root.rglob("*.py"))))


def splice(text: str, inner: str) -> str:
    """``text`` with ``inner`` between the marks; it is an error if they are missing."""
    before, mark, rest = text.partition(BEGIN)
    _, end, after = rest.partition(END)
    if not mark or not end:
        raise ValueError("the text has no marks")
    return f"{before}{BEGIN}\n{inner}\n{END}{after}"


def stale(text: str, inner: str) -> bool:
    """Whether the text holds another index than ``inner``."""
    return splice(text, inner) != text


def wrap(text: str, n: int = 40) -> list[str]:
    """Lines of at most ``n`` characters; longer words stand alone."""
    return textwrap.wrap(text, n, break_long_words=False, break_on_hyphens=False)


def embedded(path: str) -> str:
    """A file as a data address, to be carried within a page."""
    return "data:application/octet-stream;base64," + base64.b64encode(Path(path).read_bytes()).decode()
