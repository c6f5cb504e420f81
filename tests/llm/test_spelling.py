"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.shared import Scratch
from tidemark.llm.spelling import HalfIndex, _near_in, group_variants, observed_words, spelling_variants

SCHEMA = "doc_id long, text string, word string, n string"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(count: dict[str, int]) -> dict[str, tuple]:
    near = {w: [v for v in count if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in count}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = {}
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (count[w], len(near[w]), form[w], count[form[w]] if form[w] else None, root)
    return out


def words_of(docs) -> Counter:
    seen = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            seen[run] += 1
    return seen


def rows(df) -> dict[str, tuple]:
    got = [(r.word, (r.n, r.n_near, r.form, r.form_n, r.root)) for r in df.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abéÿ", min_size=2, max_size=11), min_size=1, max_size=60))
def test_an_index_finds_each_near_pair_once(words):
    found = Counter()
    for side in (0, 1):
        for longest in {len(w) + more for w in words for more in (0, 1)}:
            group = [(w[:: -1 if side else 1].encode("latin-1"), 1, len(w) == longest, True) for w in words if longest - 1 <= len(w) <= longest]
            for word, near, _, _ in _near_in(group, side, longest):
                found[word.decode("latin-1")] += near
    assert found == Counter({w: n for w in words if (n := sum(one_edit(w, v) for v in words))})


def test_ranks_of_delimiters_are_the_words():
    words = sorted({b"banana", b"ban", b"nab", b"anna", b"a", b"nanananananananana"})
    index = HalfIndex(words)
    for j, w in enumerate(words):
        low, high = 0, len(words)
        for c in w[::-1] + b"\0":
            low, high = (int(x[0]) for x in index.read(*(np.array([x]) for x in (c, low, high))))
        assert (low, high) == (j, j + 1)


def test_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    count = {w: n for w, n in words_of((r.doc_id, r.text) for r in docs.collect()).items() if len(w) >= 5 and n >= 3}
    by_rest: dict = {}
    for w in count:  # near words share a word with one letter left out; brute force over those that do
        for i in range(len(w)):
            by_rest.setdefault(w[:i] + w[i + 1:], set()).add(w)
    expected_near = {w: {v for i in range(len(w)) for v in by_rest[w[:i] + w[i + 1:]] | ({w[:i] + w[i + 1:]} & count.keys()) if one_edit(w, v)} | {v for v in by_rest.get(w, ())} for w in count}
    got = rows(spelling_variants(docs))
    assert got.keys() == count.keys()
    assert {w: g[1] for w, g in got.items()} == {w: len(v) for w, v in expected_near.items()}
    for w, (n, _, form, form_n, root) in got.items():
        best = min(expected_near[w], key=lambda v: (-count[v], v), default=None)
        want = best if best and count[best] >= 2 * n else None
        assert (form, form_n) == (want, count[want] if want else None)
        assert root == (got[form][4] if form else w)


@pytest.mark.parametrize("index_words", [1 << 17, 7])
def test_a_crowded_half_is_dealt_over_several_indexes(spark, index_words):
    words = {f"prefix{a}{b}" for a in "abcdeé" for b in "vwxyzÿ"} | {f"{a}{b}suffix" for a in "abcd" for b in "vwxy"} | {"prefixa", "prefixab", "prefxav"}
    count = {w: 1 + hash_ for hash_, w in enumerate(sorted(words))}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    assert rows(group_variants(df, Scratch(spark, "test"), index_words=index_words)) == brute(count)


def test_edges(spark):
    long = "x" * 40_000
    docs = [
        (1, "Color color colour COLOUR colour colour"), (2, None), (3, ""), (4, "12 34"), (5, "colr colr colr"), (None, "colour colour color"), (5, "colr"),
        (6, f"{long} {long} {long} {long}y {long}y {long}y"), (7, "Éclair éclair éclair éclair Éclair Éclair eclair eclair eclair"), (8, "abcd " * 5), (9, "naïve-naïve'naïveānaive naive naive " * 3),
        *((100 + i, "theatre theater theatr") for i in range(120)),
    ]
    df = spark.createDataFrame([(i, t, "w", "n") for i, t in docs], SCHEMA)
    count = {w: n for w, n in words_of(docs).items() if len(w) >= 5 and n >= 3}
    assert rows(spelling_variants(df)) == brute(count)
    assert rows(spelling_variants(df.limit(0))) == {}
    assert sorted(r.word for r in observed_words(df.filter("doc_id = 4")).collect()) == []


def test_ways_of_forms_end_in_the_last(spark):
    count = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 32, "bbbbbb": 64, "zzzzz": 5}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    got = rows(group_variants(df, Scratch(spark, "test")))
    assert got == brute(count)
    assert got["aaaaa"][4] == "bbbbbb" and got["zzzzz"][4] == "zzzzz"
    with pytest.raises(ValueError):
        group_variants(df, Scratch(spark, "test"), ratio=1)
