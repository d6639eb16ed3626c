import os
import random

import pytest

from marginalia.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="needs the public vocabulary")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


@pytest.mark.parametrize("head", [1, 16])
def test_joined_chunks_equal_whole(whole, monkeypatch, head):
    monkeypatch.setattr(tokens, "HEAD", head)
    monkeypatch.setattr(tokens, "MIN_CHUNK", 3)
    monkeypatch.setattr(tokens, "CUT_BITS", 2)
    random.seed(7)
    alphabet = ["a", "b", "'", "r", "e", "'ll", "l", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "é", "中", "１", "²", "😀", "‍", "-", "!", "1", "　", "﻿", "<|endoftext|>"]
    for _ in range(3000):
        x = "".join(random.choice(alphabet) for _ in range(random.randint(1, 70)))
        a, chunks = 0, []
        for b in tokens.cuts([x])[0]:
            c = tokens.encode_chunk(x[a:b])
            packed = {"size": c.size, "ids": tokens._packed(c.ids), "heads": tokens._packed(tokens.np.array([*c.ends, *c.upto], tokens.np.uint32)), "tail": c.tail, "tail_ids": c.tail_ids}
            chunks.append(tokens._unpacked(packed))
            a = b
        assert tokens.join_chunks(x, chunks).tolist() == whole(x)


def test_rows(spark, whole):
    long = "long text " * 20_000 + "a" * 30_000
    texts = [(1, "Hello world. " * 60), (2, None), (3, ""), (4, "<|endoftext|> [CLS]"), (5, long), (6, "Hello world. " * 60), (1, "Hello world. " * 60), (None, "x"), (7, " \n\n ")]
    df = spark.createDataFrame([(i, t, "c") for i, t in texts], "doc_id bigint, text string, ids string")
    got = sorted(((r["doc_id"] or 0, r["ids"]) for r in tokens.token_ids(df).collect()), key=lambda x: x[0])
    want = sorted({(i or 0, tuple(whole(t)) if t else ()) for i, t in texts})
    assert [(i, tuple(x)) for i, x in got] == want
    assert tokens.token_ids(df.limit(0)).count() == 0


def test_cuts_depend_on_content():
    random.seed(8)
    body = "".join(random.choice("abcdefgh ") for _ in range(4000))
    a, b = tokens.cuts([body])[0], tokens.cuts(["x" * 77 + body])[0]
    assert len({x + 77 for x in a} & set(b)) >= 0.7 * len(a) and tokens.cuts([]) == [] and tokens.cuts([""]) == [[]]


def test_ids_of_any_size_survive_packing():
    for ids in ([], [1, 65535], [65536, 3, 200_000]):
        assert tokens._unpacked({"size": 0, "ids": tokens._packed(tokens.np.array(ids, tokens.np.uint32)), "heads": b"2", "tail": 0, "tail_ids": 0}).ids.tolist() == ids


def test_a_chunk_of_a_third_of_all_documents(spark, whole):
    boiler = "All rights reserved by the invented publisher of this text, who grants nothing at all to anybody. " * 8
    texts = [(i, boiler + f"Own words {i}." if i % 3 == 0 else f"Document {i} says {i * 7}.") for i in range(300)]
    got = {r["doc_id"]: r["ids"] for r in tokens.token_ids(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == {i: whole(t) for i, t in texts}


def test_windows_hash_as_a_sum_over_their_characters(monkeypatch):
    text = "".join(chr(random.Random(5).randrange(32, 500) + k % 7) for k in range(400))
    mixed = [(ord(c) + 1) * 0x9E3779B97F4A7C15 % 2**64 for c in text]
    slow = [sum(mixed[i - k] * pow(0x5851F42D4C957F2D, k, 2**64) for k in range(tokens.WINDOW) if i >= k) % 2**64 for i in range(len(text))]
    ends, last = [], 0
    for i, h in enumerate(slow):
        if h >> (64 - tokens.CUT_BITS) == 0 and i + 1 - last >= tokens.MIN_CHUNK and i + 1 < len(text):
            ends.append(last := i + 1)
    for segment in (1 << 20, 400, 37, 16):
        monkeypatch.setattr(tokens, "SEGMENT", segment)
        assert tokens.cuts([text, "x"]) == [[*ends, len(text)], [1]]
