import unicodedata

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.bpe import Encoder, decode, encode, read_vocabulary
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \n\t", "<|endoftext|>x<|startoftext|>Y <|endoftext|", "ΣΑΣ σας ΌΣ", "İstanbul ẞ ß ﬁ ǅ", "é ́ ẹ́ éẹ́", "a\x1cb\x1f c\x85d\xa0e　f",
    "it's we'LL 'tis don't've", "日本語テキスト 한국어 123 ½ ² ⅷ", "😀👨‍👩 ##$$", "x" * 700 + " " + "ab" * 400, "a​b﻿", "\x00\x01 null",
    "é" * 300 + "!!!" * 100, "q" * 250 + "uéê" * 80,
]


@pytest.fixture(scope="module")
def ours():
    return Encoder(read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(encoder, text):
    return memoryview(encoder.encode(text)).cast("i").tolist()


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("abehnort' éê!<|>endoftx́Σ", max_size=60))
def test_any_text_encodes_as_the_library_does(ours, library, text):
    assert ids_of(ours, text) == library.encode(text, add_special_tokens=False).ids


def test_every_code_point_encodes_as_the_library_does(ours, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    shapes = ("a?{}B1", "x{}\u0334", "x\u0345{}")  # among letters, before a low mark, after a high one
    texts = [s.format(c) for c in points for s in (shapes if unicodedata.category(c) in ("Mn", "Mc") else shapes[:1])]
    texts += [d for c in points if (d := unicodedata.normalize("NFD", c)) != c]
    for i in range(0, len(texts), 20_000):
        for t, e in zip(texts[i : i + 20_000], library.encode_batch(texts[i : i + 20_000], add_special_tokens=False)):
            assert ids_of(ours, t) == e.ids, ascii(t)


def test_forced_boundaries_cut_only_where_no_token_reaches(ours):
    text = "éêthe"
    assert (text.encode()[1], text.encode()[2]) not in ours.v.joined and (ord("t"), ord("h")) in ours.v.joined


def test_spark_round_trip(spark, library):
    rows = [(i, t, "keep", 7) for i, t in enumerate([*ODD, None, ODD[2], ODD[2]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, `odd name` int")
    vocabulary = read_vocabulary(PATH)
    got = decode(encode(df, vocabulary), vocabulary).orderBy("doc_id").collect()
    assert encode(df, vocabulary, decoded_col="decoded").orderBy("doc_id").collect() == got
    want = [library.encode(t or "", add_special_tokens=False).ids for _, t, *_ in rows]
    assert [r.ids for r in got] == want
    assert [r.decoded for r in got] == [library.decode(i, skip_special_tokens=False) for i in want]
    assert [(r.text, r["odd name"]) for r in got] == [(t, 7) for _, t, *_ in rows]
    assert encode(df.filter("doc_id < 0"), vocabulary).collect() == []


def test_query_equals_the_library(spark, library):
    from hashlib import sha256

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op8_bpe"](spark, sf).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
