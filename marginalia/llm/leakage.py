"""Passages of held-out test items in training text: a BM25 index with block-max WAND, then exact verification."""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.session import spread

#: A passage is so many words, the next begins STEP later; every run of RUN words lies whole in one.
PASSAGE, STEP, RUN = 40, 25, 15
HALF = (RUN + 1) // 2
#: BM25, the postings of a block of a cursor, and the most blocks whose bounds are added up for a passage.
K1, B, BLOCK, BOUNDS = 1.2, 0.75, 32, 4096
#: An altered whole has one word in so many altered.
ALTERED = 10
#: The share of an altered item's words that must stand in order, and how much longer than the item its place may be.
COVER, STRETCH = 0.75, 1.4

_TAG = re.compile(r"<[/!]?[A-Za-z-][^<>]*>")
_SPLIT = re.compile(r"[-‐‑\xad][ \t]*(?:\r\n|\r|\n)[ \t>]*(?=[^\W\d_])")
_SOFT = re.compile(r"[\xad​-‍⁠﻿]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """The words of a text without case, markup, punctuation and line breaks; words split at line ends are joined."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    text = _SOFT.sub("", _SPLIT.sub("", text))
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _WORD.findall(text.lower())


def own_texts(items: list[tuple[int, str | None]]) -> list[tuple[int, str]]:
    """The items without the lead-in (up to the first colon) that several of them share; NULL and empty items are left out."""
    lead = Counter(" ".join(words(t.split(":", 1)[0])) for _, t in items if t and ":" in t)
    out = []
    for i, t in items:
        if t and ":" in t and lead[" ".join(words(t.split(":", 1)[0]))] > 1:
            t = t.split(":", 1)[1]
        if t and words(t):
            out.append((i, t))
    return out


@dataclass
class Index:
    """The items' words and impacts, and for each term the bounds of the blocks of items that hold it."""

    ids: list[int] = field(default_factory=list)
    item_words: list[list[str]] = field(default_factory=list)
    runs: list[list[str]] = field(default_factory=list)
    #: every run holds one of these whole: the item cut into pieces of HALF words
    pieces: list[list[str]] = field(default_factory=list)
    sentences: list[list[str]] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    weights: list[dict[str, float]] = field(default_factory=list)
    #: term -> (blocks of items that hold it, its highest impact in each); a block's items are neighbours, ``width`` of them
    bounds: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    width: int = 1
    needs: np.ndarray = field(default_factory=lambda: np.empty(0))


def floor_of(words: list[str], weight: dict[str, float], longest: int) -> float:
    """The score that some passage of any repetition of an item reaches.

    A run of RUN words lies whole in a passage and scores no less than the item's weakest run. Of an altered whole of n words some passage holds at least
    (n + PASSAGE - STEP) / 2 in a row, no fewer than the lesser of n and PASSAGE allow; its weakest such stretch is taken without as many of its heaviest words as may be altered in all.
    Sentences in another order hold a run unless all of them are shorter (``longest`` words); then a passage may hold any words of the item, the lightest are taken.
    """
    n = len(words)
    run = min(sum(weight[t] for t in set(words[j : j + RUN])) for j in range(max(1, n - RUN + 1)))
    stretch = min(n, PASSAGE, (n + PASSAGE - STEP) // 2)
    whole = min(
        sum(sorted((weight[t] for t in set(words[j : j + stretch])), reverse=True)[math.ceil(n / ALTERED) :]) for j in range(max(1, n - stretch + 1))
    )
    mixed = sum(sorted(weight[t] for t in set(words))[:stretch]) if longest < RUN else run
    return min(run, whole, mixed) - 1e-6


def build(own: list[tuple[int, str]]) -> Index:
    """The inverted index of items' own texts (see :func:`own_texts`), with the score that some passage of any repetition of an item reaches."""
    ix = Index()
    counts, longest = [], []
    for i, t in own:
        w = words(t)
        ix.ids.append(i)
        ix.item_words.append(w)
        ix.runs.append(["".join(w[k : k + RUN]) for k in range(max(1, len(w) - RUN + 1))])
        ix.pieces.append(["".join(w[k : k + HALF]) for k in range(0, max(1, len(w) - HALF + 1), HALF)])
        parts = [x for x in map(words, re.split(r"(?<=[.!?])\s+", t)) if x]
        ix.sentences.append(["".join(x) for x in parts])
        longest.append(max(map(len, parts)) if len(parts) > 1 else len(w))
        counts.append(Counter(w))
    n, mean = len(own), sum(map(len, ix.item_words)) / max(1, len(own))
    df = Counter(t for c in counts for t in c)
    lists: dict[str, list[tuple[int, float]]] = {}
    for k, c in enumerate(counts):
        weight = {}
        for t, f in c.items():
            idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
            weight[t] = idf * f * (K1 + 1) / (f + K1 * (1 - B + B * len(ix.item_words[k]) / mean))
            lists.setdefault(t, []).append((k, weight[t]))
        ix.weights.append(weight)
        ix.threshold.append(floor_of(ix.item_words[k], weight, longest[k]))
    ix.width = -(-n // BOUNDS) or 1
    blocks = -(-n // ix.width)
    ix.needs = np.array([min(ix.threshold[b * ix.width : (b + 1) * ix.width]) for b in range(blocks)])
    for t, plist in lists.items():
        top: dict[int, float] = {}
        for k, s in plist:
            top[k // ix.width] = max(s, top.get(k // ix.width, 0.0))
        ix.bounds[t] = np.array(list(top), np.int64), np.array(list(top.values()))
    return ix


class _Cursor:
    __slots__ = ("bound", "blocks", "b", "i", "doc")

    def __init__(self, bound, blocks):
        self.bound, self.blocks, self.b, self.i = bound, blocks, 0, 0
        self.doc = blocks[0][2][0]

    def seek(self, doc: int) -> None:
        """The first posting at or after ``doc``; whole blocks are skipped by their last item."""
        blocks = self.blocks
        while self.b < len(blocks) and blocks[self.b][0] < doc:
            self.b += 1
            self.i = 0
        if self.b == len(blocks):
            self.doc = math.inf
            return
        items = blocks[self.b][2]
        while items[self.i] < doc:
            self.i += 1
        self.doc = items[self.i]

    def block_bound(self, doc: int) -> float:
        """The highest impact of the block that would hold ``doc``."""
        for b in range(self.b, len(self.blocks)):
            if self.blocks[b][0] >= doc:
                return self.blocks[b][1]
        return 0.0

    def score(self) -> float:
        return self.blocks[self.b][3][self.i]


def alive(ix: Index, terms: list[str]) -> list[int]:
    """The items of the blocks whose bounds for ``terms`` reach the least that one of their items needs."""
    held = [ix.bounds[t] for t in terms]
    if not held:
        return []
    total = np.bincount(np.concatenate([h[0] for h in held]), weights=np.concatenate([h[1] for h in held]), minlength=len(ix.needs))
    return [k for b in np.flatnonzero(total >= ix.needs).tolist() for k in range(b * ix.width, min((b + 1) * ix.width, len(ix.ids)))]


def wand(ix: Index, terms: set[str]) -> list[int]:
    """All items whose BM25 score for ``terms`` reaches their threshold, by block-max WAND.

    The bounds of all blocks of items are added up first; cursors then walk the postings of the blocks that may hold a hit, skipping by the
    highest impacts of their own blocks.
    """
    known = [t for t in terms if t in ix.bounds]
    items = alive(ix, known)
    if not items:
        return []
    found: list[int] = []
    least = min(ix.threshold[k] for k in items)
    cursors = []
    for t in known:
        plist = [(k, s) for k in items if (s := ix.weights[k].get(t))]
        if plist:
            parts = [plist[j : j + BLOCK] for j in range(0, len(plist), BLOCK)]
            cursors.append(_Cursor(max(s for _, s in plist), [(b[-1][0], max(s for _, s in b), [k for k, _ in b], [s for _, s in b]) for b in parts]))
    while cursors:
        cursors.sort(key=_at)
        total, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            total += c.bound
            if total >= least:
                pivot = k
                break
        if pivot < 0:
            break
        doc = cursors[pivot].doc
        while pivot + 1 < len(cursors) and cursors[pivot + 1].doc == doc:
            pivot += 1
        head = cursors[: pivot + 1]
        if len(cursors[0].blocks) > 1 and sum([c.block_bound(doc) for c in head]) < least:
            for c in head:
                c.seek(doc + 1)
        elif cursors[0].doc == doc:
            if sum([c.score() for c in head]) >= ix.threshold[doc]:
                found.append(doc)
            for c in head:
                c.seek(doc + 1)
        else:
            for c in head:
                if c.doc < doc:
                    c.seek(doc)
        cursors = [c for c in cursors if c.doc != math.inf]
    return found


def _at(c: _Cursor):
    return c.doc


def _in_order(a: list[str], b: list[str]) -> int:
    """The length of the longest common subsequence of two word lists, by bit vectors."""
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    row = 0
    for w in b:
        x = row | at.get(w, 0)
        row = x & ((x - ((row << 1) | 1)) ^ x)
    return row.bit_count()


def leaked(ix: Index, text: str) -> list[tuple[int, str, float]]:
    """(item, kind, share of the item found) for every item that ``text`` repeats: 'run', 'sentences' or 'altered'."""
    doc = words(text)
    candidates: dict[int, list[int]] = {}
    for a in range(0, max(1, len(doc) - PASSAGE + STEP), STEP):
        for k in wand(ix, set(doc[a : a + PASSAGE])):
            candidates.setdefault(k, []).append(a)
    if not candidates:
        return []
    letters, have, out = "".join(doc), set(doc), []
    for k, places in sorted(candidates.items()):
        item = ix.item_words[k]
        hits = sum(r in letters for r in ix.runs[k]) if any(p in letters for p in ix.pieces[k]) else 0
        if hits:
            out.append((ix.ids[k], "run", hits / len(ix.runs[k])))
            continue
        if len(ix.sentences[k]) > 1 and all(s in letters for s in ix.sentences[k]):
            out.append((ix.ids[k], "sentences", 1.0))
            continue
        if sum(w in have for w in item) < COVER * len(item):
            continue
        best, size = 0, int(len(item) * STRETCH) + PASSAGE
        for a in places[:: max(1, len(item) // (2 * STEP))]:
            lo = max(0, a - len(item))
            for b in range(lo, a + PASSAGE, max(1, len(item) // 4)):
                best = max(best, _in_order(item, doc[b : b + size]))
        if best >= COVER * len(item):
            out.append((ix.ids[k], "altered", best / len(item)))
    return out


def _search(shared):
    def run(batches):
        ix = shared.value
        for batch in batches:
            rows, item, kind, share = [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for k, what, part in leaked(ix, t):
                    rows.append(i)
                    item.append(k)
                    kind.append(what)
                    share.append(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(item, pa.int64()), pa.array(kind, pa.string()), pa.array(share, pa.float64())],
                ["id", "item_id", "kind", "share"],
            )

    return run


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", most: int = 50_000) -> DataFrame:
    """Every document that repeats a test item: doc_id, item_id, kind, share of the item.

    An index of at most ``most`` items is built once and sent to all executors; more items are split into as many indexes, searched one after the
    other, after the lead-ins that items share were counted over all of them. Every document's overlapping passages query the index by block-max
    WAND, retrieving all items above thresholds that no true repetition can miss; candidates are then compared letter by letter, and in order for altered wholes.

    Defined cases: NULL and empty documents or items match nothing; items without own text after their lead-in are left out;
    repeated documents come out each, repeated items under each id; extra columns are dropped; documents of any length are read whole.
    """
    spark = docs.sparkSession
    key = docs.schema[doc_id].dataType.simpleString()
    texts = spread(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text <> ''"))
    rows = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).where("i is not null and t <> ''")
    own = own_texts([(r["i"], r["t"]) for r in rows.toLocalIterator()])
    out = None
    for k in range(0, max(1, len(own)), most):
        shared = spark.sparkContext.broadcast(build(own[k : k + most]))
        part = texts.mapInArrow(_search(shared), f"id {key}, item_id bigint, kind string, share double")
        out = part if out is None else out.union(part)
    return out.withColumnRenamed("id", doc_id)
