"""Token alignment against a plain alignment of whole texts."""

import hashlib
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import alignment
from tidemark.llm.alignment import _CUT, Pair, align, align_tokens

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return Pair.read(*PATHS)


def plain_tokens(pair, text):
    """(A ids, B ids, links, groups) of a whole text from the two libraries and the tokens' bytes alone."""
    a, b, bytes_a, bytes_b, _ = pair.load()
    data = (" " + (text or "")).encode()
    ia, ib = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    if not text or b"".join(bytes_a[i] for i in ia) != data or b"".join(bytes_b[i] for i in ib) != data:
        return [], [], [], ""
    at_a = [i for i in ia for _ in bytes_a[i]]
    end_a = set(accumulate(len(bytes_a[i]) for i in ia))
    end_b = set(accumulate(len(bytes_b[i]) for i in ib))
    at_b = [i for i in ib for _ in bytes_b[i]]
    links, groups = [], []
    for k in range(len(data)):
        if k == 0 or k in end_a or k in end_b:
            links.append((at_a[k], at_b[k]))
        if k == 0 or (k in end_a and k in end_b):
            groups.append(([], []))
        if k == 0 or k in end_a:
            groups[-1][0].append(at_a[k])
        if k == 0 or k in end_b:
            groups[-1][1].append(at_b[k])
    return ia, ib, links, ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def brute(pair, docs):
    done = [(i, *plain_tokens(pair, t)) for i, t in docs]
    count = Counter(link for _, _, _, links, _ in done for link in links)
    best: dict = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(
        (str(i), len(a), len(b), g.count("|"), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
         hashlib.sha256(g.encode()).hexdigest() if a else "")
        for i, a, b, links, g in done
    )


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


ODD = [
    "", None, " ", "  ", "a", " leading", "trailing ", "two  spaces", "tab\tnew\nline \n x", "▁ mark", "a▁b", "é", "漢字", "\U0001F600", "\U0001F468‍\U0001F469 fam",
    "don't it's we'll", "<|endoftext|> </s> <s> <unk> <0x41>", "\u0000null", "ſ   nbsp x 　y", "é combining", "１２３ ①", "Ᲊ Ɤ unassigned", "x" * 5000, "漢" * 3000, "word " * 4000,
    "\r\n\r\n", "ÿ ÿ × ÷ À", "a -b +c 1 2", "﻿bom", "<|endoftext|>",
]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\taAé漢\U0001F600'.1-<|>ÿ▁"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_fragments_are_the_text(text):
    pair = Pair.read(*PATHS)
    ia, ib, links, groups = plain_tokens(pair, text)
    if not text:
        return
    found = align(_CUT.split(text), pair)
    if not found.good.all():
        assert not ia
        return
    assert list(found.sizes.sum(0)) == [len(ia), len(ib), groups.count("|"), len(links)]
    assert list(zip(found.links_a.tolist(), found.links_b.tolist())) == links
    assert ";".join(found.groups) == groups


def test_sample(spark, pair):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(align_tokens(docs, pair)) == brute(pair, [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("slice_bytes", [1, 3000, 16 << 20])
def test_edges(spark, pair, slice_bytes):
    docs = [*enumerate(ODD), (3, "a repeated row"), (3, "a repeated row"), (None, "no id")]
    df = spark.createDataFrame([(i, t, "s", "n") for i, t in docs], "doc_id long, text string, slice string, n_a string").repartition(2)
    assert got(align_tokens(df, pair, slice_bytes=slice_bytes)) == brute(pair, docs)
    assert align_tokens(df.limit(0), pair).collect() == []


def test_texts_without_tokens_alone(spark, pair):
    df = spark.createDataFrame([("x", None), ("y", ""), ("z", "▁")], "key string, body string")
    assert got(align_tokens(df, pair, "key", "body")) == [(k, 0, 0, 0, 0, 0, 0, "") for k in "xyz"]


def test_short_fragments_are_encoded_together(pair, monkeypatch):
    words = [f"w{i}" for i in range(700)]
    words[100:600:50] = ["a▁b", "ﬁsh", "é", "x\ny", "don't", "two  spaces", "漢字", " lead", "a" * 100, "\t"]
    alone = [align([w], pair) for w in words]
    seen, encode = [], alignment._encode
    monkeypatch.setattr(alignment, "_encode", lambda texts, p: seen.extend(texts) or encode(texts, p))
    found = align(words, pair)
    assert len(seen) < 350  # before, each was handed to both libraries alone
    assert found.good.tolist() == [x.good[0] for x in alone] and not found.good[100]
    assert found.sizes.tolist() == [x.sizes[0].tolist() for x in alone] and found.groups == [x.groups[0] for x in alone]
    assert list(zip(found.links_a, found.links_b)) == [z for x in alone for z in zip(x.links_a, x.links_b)]


def test_rows_of_a_slice_stay_small(pair):
    schema = pa.schema([
        ("slice", pa.string()), ("part", pa.int32()), ("ids", pa.list_(pa.int64())), ("sha", pa.list_(pa.string())), ("data", pa.binary()),
        ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
    ])
    texts = [" ".join(f"w{i}x{j}" for i in range(40)) for j in range(2500)]
    made = alignment._slice(pa.array(range(len(texts))), pa.chunked_array([texts]), pair, schema)
    assert made.num_rows > 2 and max(made.slice(i, 1).nbytes for i in range(made.num_rows)) < 300 << 10
    assert made.column("part").to_pylist() == list(range(made.num_rows))


def test_a_slice_of_empty_texts_has_an_end():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 900)), pa.array([None, "", "a"] * 300)], ["id", "text"]) for i in (0, 900)]
    found = list(alignment._cut_rows(batches, 10 << 10))
    assert [t.column("id").to_pylist() for t in found] and sum((t.column("id").to_pylist() for t in found), []) == list(range(1800))
    assert max(t.num_rows for t in found) <= 320
    long = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a", "x" * 3000, "b"])], ["id", "text"])
    assert [t.num_rows for t in alignment._cut_rows([long, long.slice(0, 0)], 2000)] == [1, 1, 1]
    assert list(alignment._cut_rows([long.slice(0, 0)], 2000)) == []
