import re
from collections import defaultdict

import pytest

from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.minhash import near_dedup
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, id string, n long, set string, component_id string, kept int"
PLAIN = "a b c d e f g h i j k l m n o p q r s t u v w x y z"


def frame(spark, rows, schema=SCHEMA):
    """Rows of (doc_id, text) beside columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *["x", 1, "y", "z", 2][: len(schema.split(",")) - 2]) for r in rows], schema)


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    where = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            where[x].add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in where[x] if j < i}:
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_dedup_equals_brute_force(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_minhash"](spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got == brute_components(rows)


def test_near_dedup_of_chains_and_one_bucket(spark):
    words = [f"w{i}" for i in range(60)]
    # each text moves on by one word: neighbours are linked, the ends are not similar at all
    rows = [(100 + i, " ".join(words[i : i + 30])) for i in range(30)]
    rows += [(200 + i, " ".join(f"same{j}" for j in range(100)) + f" tail{i}") for i in range(40)]
    rows += [(300 + i, " ".join(f"part{j}" for j in range(60)) + " " + " ".join(f"own{i}-{j}" for j in range(40))) for i in range(12)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(frame(spark, rows)).collect()}
    assert got == brute_components(rows)
    assert got[129][1] == 100 and got[239][1] == 200 and got[311][1] == 311


def test_near_dedup_edges(spark):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "A b"), (8, "a B"), (7, "a b c"), (6, PLAIN), (2, PLAIN.upper()), (2, PLAIN.upper()),
            (1, "É b c d e"), (10, "é b c d e"), (None, PLAIN), (20, "x1 x2 x3 x4 x5"), (20, PLAIN), (21, "x1 x2 x3 x4 x5")]
    got = sorted((tuple(r) for r in near_dedup(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    want = [(5, 0, 5, True), (4, 0, 4, True), (3, 0, 3, True), (9, 1, 8, False), (8, 1, 8, True), (7, 1, 7, True), (6, 22, 2, False),
            (2, 22, 2, True), (2, 22, 2, True), (1, 1, 1, True), (10, 1, 10, True), (20, 1, 2, False), (20, 22, 2, False), (21, 1, 2, False)]
    assert [g for g in got if g[0] is not None] == sorted(want, key=str)
    assert [(g[1], g[3]) for g in got if g[0] is None] == [(22, True)]
    assert near_dedup(frame(spark, [])).collect() == []


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    return sorted((i, min(g)[1], len(g), i == min(g)[1]) for g in groups.values() for _, i in g)


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_dedup_equals_brute_force(spark, bits):
    long = "lörem ipsum 𝄞 " * 20
    rows = [(1, None), (2, ""), (3, "  "), (4, "a b"), (5, "ab"), (6, "a\tb\n"), (7, "a b"), (8, long), (9, long + " "), (10, long[:-3]),
            (11, long + "x"), (12, "x" + long), (13, "x" * 16), (14, "x" * 17), (15, "x" * 24), (16, "x" * 16 + " "), (17, long * 2), (18, long * 2)]
    got = exact_dedup(frame(spark, rows), block_chars=8, hash_bits=bits).drop("text_sha256").collect()
    assert sorted(tuple(r) for r in got) == brute_exact(rows)


def test_exact_dedup_edges(spark):
    assert exact_dedup(frame(spark, [])).collect() == []
    got = exact_dedup(frame(spark, [(1, "a"), (1, "a"), (None, " a"), (None, "a")])).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in got) == [
        (-1, None, 4, False), (-1, None, 4, True), (1, None, 4, False), (1, None, 4, False)]
    got = exact_dedup(frame(spark, [(1, "a"), (1, "a"), (None, "a")])).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.kept) for r in got) == [(-1, 1, False), (1, 1, False), (1, 1, True)]
