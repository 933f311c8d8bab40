"""Encoding and decoding against the tokenizers library."""

import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from broadsheet.llm import bpe, queries
from broadsheet.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = bpe.Vocabulary(open(PATH, encoding="utf-8").read())


def ids_of(texts):
    return [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in VOCABULARY.encode(texts)]


def wanted(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "", " \n ", "Don't, it'll x'lly 'S", "aaaa aaaaaaa aaaaaaaaaaaaaaaaaaaaa", "a<|endoftext|>b <|startoftext|><|ENDOFTEXT|><|",
    "ΑΣ ΣΑΣ ΟΔΟΣ", "İstanbul ǅ ﬁ", "é ̈x a​b a b a\x1cb\x85c　d", "1234½²Ⅷ", "日本語 テキスト 한국어", "\U0001F600\U0001F468‍\U0001F469",
    "a՘b Ƛ Ᲊ", "x" * 3000, "ab" * 2000 + "!" * 500, "﻿BOM \x00 \x7f",
]


def test_texts():
    assert ids_of([None, *TEXTS]) == [[], *map(wanted, TEXTS)]
    for t in TEXTS:
        assert VOCABULARY.decode(wanted(t)) == LIBRARY.decode(wanted(t), skip_special_tokens=False)


def test_every_code_point_class():
    texts = [f"a{chr(c)}B {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 97 == 0)]
    assert ids_of(texts) == [wanted(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert ids_of([text]) == [wanted(text)]


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Vocabulary(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())


def test_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    for t in TEXTS + TEXTS:
        assert ids_of([t, "other words here"]) == [wanted(t), wanted("other words here")]


def test_frames(spark):
    rows = [(1, "some words", "x"), (1, "some words", "x"), (None, None, None), (2, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in got) == [
        (0, [], ""), (1, wanted("some words"), "some</w> words</w>"), (1, wanted("some words"), "some</w> words</w>"), (2, [], ""),
    ]
    assert bpe.round_trip(df.limit(0), PATH).collect() == [] and bpe.encode(df.limit(0), PATH).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    want = {}
    for r in table(spark, folder, "documents").collect():
        ids = wanted(r["text"])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (
            len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        )
    got = {r[0]: tuple(r[1:]) for r in queries.QUERIES["op7_pair_index_bpe"](spark, folder).collect()}
    assert got == want
