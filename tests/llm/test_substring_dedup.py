import random
import re
from collections import defaultdict

from tidemark.llm.substring_dedup import remove_repeats


def brute(rows, window=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = defaultdict(lambda: 10**9)
    for (i, _), w in zip(rows, words):
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            first[key] = min(first[key], 10**9 if i is None else i)
    out = []
    for (i, t), w in zip(rows, words):
        gone = {x for j in range(len(w) - window + 1) for x in range(j, j + window) if i is not None and first[tuple(w[j : j + window])] < i}
        out.append((i, t, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n_words int, tag string, id int").repartition(parts)
    return sorted((tuple(r) for r in remove_repeats(df).collect()), key=str)


def test_planted_passages(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "and", f"w{rng.randrange(3000)}", f"é{rng.randrange(50)}"])
    passages = [[word() for _ in range(n)] for n in (12, 13, 14, 60)]
    rows = []
    for i in range(120):
        w = [word() for _ in range(rng.randrange(80))]
        for p in rng.sample(passages, rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = p
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(500 + i, rows[3][1]) for i in range(30)] + [(600, "the " * 400), (601, "the " * 13), (602, "the of " * 300), (3, rows[3][1])]
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(20))
    twice = long + " between " + long
    rows = [(5, None), (4, ""), (3, " \n"), (2, "one"), (7, long), (7, long), (6, twice), (9, long.replace("a0", "b0")), (None, long), (10, "x" * 100_000), (7, "other text")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(1, long), (2, "\x0b" + long + "\x0c")], 1) == brute([(1, long), (2, "\x0b" + long + "\x0c")])
    assert run(spark, []) == []


def test_a_long_document_crosses_slices(spark):
    body = " ".join(f"w{i % 9973}" for i in range(700_000))
    rows = [(1, "w5 " * 20), (2, body), (3, body[:200_000])]
    got = {r[0]: r[2:4] for r in run(spark, rows)}
    want = {r[0]: r[2:4] for r in brute(rows)}
    assert got == want
