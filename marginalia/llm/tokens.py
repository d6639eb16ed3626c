"""Token ids of whole texts by a public tokenizer, with content-defined chunks encoded once."""

from __future__ import annotations

import functools
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.session import spread

#: Where the public vocabularies lie, and the pattern that splits text before their merges (the same on every release).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The rolling hash looks at so many characters; a chunk has at least MIN_CHUNK and about 2**CUT_BITS characters more.
WINDOW, MIN_CHUNK, CUT_BITS = 16, 64, 8
#: Characters hashed at once, and documents joined at once: what a worker holds stays small whatever a batch holds.
SEGMENT, JOINED = 1 << 20, 500
#: How far back from its end a piece of the pattern may be decided by what follows: one character of lookahead, two of a contraction.
REACH = 3


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    """(splitter, piece -> ids). White space is the Unicode property, as in the tokenizers' own engines."""
    import base64

    import regex
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    split = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    return split, _Pieces(enc._core_bpe.encode_single_piece).__getitem__


class _Pieces(dict):
    """The ids of pieces, each encoded once; long pieces and those beyond a number of them are not kept."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> list[int]:
        ids = self.encode(piece.encode())
        if len(piece) < 64 and len(self) < 100_000:
            self[piece] = ids
        return ids


def _hits(codes: np.ndarray, start: int) -> np.ndarray:
    """The ends of windows in SEGMENT characters from ``start`` on whose hash has CUT_BITS zero bits."""
    before = max(0, start - WINDOW + 1)
    h = (codes[before : start + SEGMENT].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    # the hash of a window is that of its halves, so four steps make windows of sixteen
    width = 1
    while width < WINDOW:
        if width < len(h):
            h[width:] = h[width:] + h[:-width] * np.uint64(pow(0x5851F42D4C957F2D, width, 2**64))
        width *= 2
    return np.flatnonzero(h[start - before :] >> np.uint64(64 - CUT_BITS) == 0) + start + 1


def cuts(texts: list[str]) -> list[list[int]]:
    """The chunk ends of each text: where the rolling hash of the last WINDOW characters has CUT_BITS zero bits."""
    if not texts:
        return []
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    hits = np.concatenate([_hits(codes, a) for a in range(0, len(codes), SEGMENT)] or [np.empty(0, np.int64)])
    out, start = [], 0
    for t in texts:
        end, last, own = start + len(t), start, []
        for c in hits[np.searchsorted(hits, start + MIN_CHUNK) : np.searchsorted(hits, end)].tolist():
            if c - last >= MIN_CHUNK:
                own.append(c - start)
                last = c
        if end > start:
            own.append(end - start)
        out.append(own)
        start = end
    return out


#: Of a chunk's pieces so many from its start are kept for finding agreement with what is encoded across the join.
HEAD = 8


@dataclass(frozen=True)
class Encoded:
    """A chunk encoded by itself: its length, its ids, the ends of its first pieces with the number of ids up to each, and the last end that what follows can't change."""

    size: int
    ids: np.ndarray
    ends: list[int]
    upto: list[int]
    tail: int
    tail_ids: int


def _chunks(with_text: bool):
    """One row per chunk of (id, text, digest of the text): id, digest, number and digest of the chunk, and the chunk itself if asked for."""

    def run(batches):
        import xxhash

        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows, seq, k1, k2, text = [], [], [], [], []
            for i, (t, ends) in enumerate(zip(texts, cuts(texts))):
                a = 0
                for n, b in enumerate(ends):
                    part = t[a:b]
                    d = xxhash.xxh3_128_intdigest(part.encode())
                    rows.append(i)
                    seq.append(n)
                    k1.append((d >> 64) - 2**63)
                    k2.append((d & (2**64 - 1)) - 2**63)
                    if with_text:
                        text.append(part)
                    a = b
            keys = [pa.array(k1, pa.int64()), pa.array(k2, pa.int64())]
            if with_text:
                yield pa.RecordBatch.from_arrays([*keys, pa.array(text, pa.string())], ["k1", "k2", "chunk"])
            else:
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array(seq, pa.int32()), *keys], ["id", "whole", "seq", "k1", "k2"])

    return run


def encode_chunk(chunk: str, vocabulary: str = VOCABULARY) -> Encoded:
    """A chunk taken by itself."""
    split, encode = _encoder(vocabulary)
    pieces = split.findall(chunk)
    coded = list(map(encode, pieces))
    ends, upto = list(accumulate(map(len, pieces))), list(accumulate(map(len, coded)))
    final = bisect_right(ends, len(chunk) - REACH)
    tail, tail_ids = (ends[final - 1], upto[final - 1]) if final else (0, 0)
    return Encoded(len(chunk), np.fromiter(chain.from_iterable(coded), np.uint32, upto[-1] if upto else 0), ends[:HEAD], upto[:HEAD], tail, tail_ids)


def _encode(vocabulary: str):
    def run(batches):
        for batch in batches:
            done = [encode_chunk(t, vocabulary) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([d.size for d in done], pa.int32()), pa.array([_packed(d.ids) for d in done], pa.binary()),
                    pa.array([_packed(np.array([*d.ends, *d.upto], np.uint32)) for d in done], pa.binary()), pa.array([d.tail for d in done], pa.int32()), pa.array([d.tail_ids for d in done], pa.int32()),
                ],
                _BOOK,
            )

    return run


_BOOK = ["k1", "k2", "size", "ids", "heads", "tail", "tail_ids"]


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers in two bytes each where they fit, else four; the first byte says which."""
    wide = bool(len(numbers)) and int(numbers.max()) > 0xFFFF
    return (b"4" if wide else b"2") + numbers.astype("<u4" if wide else "<u2").tobytes()


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4" if packed[:1] == b"4" else "<u2", offset=1)


def _unpacked(part: dict) -> Encoded:
    heads = _numbers(part["heads"]).tolist()
    half = len(heads) // 2
    return Encoded(part["size"], _numbers(part["ids"]), heads[:half], heads[half:], part["tail"], part["tail_ids"])


def join_chunks(text: str, chunks: list[Encoded], vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a text from those of its chunks.

    A chunk's pieces are final up to REACH characters before its end. From there the text is split
    and encoded anew until a piece ends where one of the next chunk's first pieces does: from that point both agree. A chunk without such a
    piece is encoded anew as a whole.
    """
    split, encode = _encoder(vocabulary)
    out: list[np.ndarray] = []
    fresh: list[int] = []
    pos = start = at = 0  # final up to pos; chunk ``at`` begins at start
    agreed = agreed_ids = 0  # where in chunk ``at`` its own pieces hold, and how many of its ids come before
    while at < len(chunks):
        c = chunks[at]
        end, upto = (c.size, len(c.ids)) if at == len(chunks) - 1 else (c.tail, c.tail_ids)
        if end > agreed:
            if fresh:
                out.append(np.array(fresh, np.int32))
                fresh = []
            out.append(c.ids[agreed_ids:upto].astype(np.int32))
            pos = start + end
        start += c.size
        at += 1
        while at < len(chunks):
            c = chunks[at]
            if pos >= start:
                begin = pos - start
                if begin == 0:
                    agreed = agreed_ids = 0
                    break
                if begin >= c.size:
                    start += c.size
                    at += 1
                    continue
                k = bisect_left(c.ends, begin)
                if k < len(c.ends) and c.ends[k] == begin:
                    agreed, agreed_ids = begin, c.upto[k]
                    break
            m = split.match(text, pos)
            fresh += encode(m.group())
            pos = m.end()
    if fresh:
        out.append(np.array(fresh, np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def _assemble(vocabulary: str):
    def run(batches):
        for batch in batches:
            done = []
            lists = (parts for a in range(0, batch.num_rows, JOINED) for parts in batch.column(1).slice(a, JOINED).to_pylist())
            for parts in lists:
                by_seq = {p["seq"]: p for p in parts}  # repeated rows repeat their chunks
                done.append(join_chunks(by_seq[-1]["text"], [_unpacked(by_seq[i]) for i in range(len(by_seq) - 1)], vocabulary))
            ends = np.cumsum([0, *map(len, done)], dtype=np.int32)
            flat = np.concatenate(done) if done else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "ids"])

    return run


def token_ids(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The ids of every whole text, without special tokens: ``doc_id`` and ``ids``, exactly as if encoded in one piece.

    Texts are cut into content-defined chunks, equal chunks of all documents are encoded once, and each document's
    chunks are joined again with the joins encoded anew until both sides agree. What moves are a chunk's text once per distinct chunk, its packed ids once
    per place, and each text once.

    Defined cases: NULL and empty texts give an empty list; special tokens' strings are ordinary text; a row repeated with the same id and
    text comes out once, the same id with several texts once per text; extra columns are dropped; empty input, empty result.
    """
    key = df.schema[doc_id].dataType.simpleString()
    docs = spread(df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")))
    full = docs.where("text <> ''").withColumn("whole", F.xxhash64("text"))
    book = (
        full.mapInArrow(_chunks(True), "k1 bigint, k2 bigint, chunk string")
        .groupBy("k1", "k2")
        .agg(F.first("chunk").alias("chunk"))
        .mapInArrow(_encode(vocabulary), "k1 bigint, k2 bigint, size int, ids binary, heads binary, tail int, tail_ids int")
    )
    # sorted and merged, so that a chunk of a third of all documents can be split by the adaptive plan; never broadcast
    places = full.mapInArrow(_chunks(False), f"id {key}, whole bigint, seq int, k1 bigint, k2 bigint")
    parts = places.hint("merge").join(book.hint("merge"), ["k1", "k2"]).select("id", "whole", F.struct("seq", F.lit(None).cast("string").alias("text"), *_BOOK[2:]).alias("part"))
    blank = {"size": "int", "ids": "binary", "heads": "binary", "tail": "int", "tail_ids": "int"}
    texts = full.select("id", "whole", F.struct(F.lit(-1).alias("seq"), "text", *(F.lit(None).cast(t).alias(c) for c, t in blank.items())).alias("part"))
    done = parts.union(texts).groupBy("id", "whole").agg(F.collect_list("part").alias("parts")).select("id", "parts").mapInArrow(_assemble(vocabulary), f"id {key}, ids array<int>")
    none = docs.where("text is null or text = ''").select("id").distinct().select("id", F.array().cast("array<int>").alias("ids"))
    return done.unionByName(none).withColumnRenamed("id", doc_id)
