import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm.mixing import BLOCK_TOKENS, draw, fit, weights

TOKENS = {"a": 6_000, "b": 3_000, "c": 1_000}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def test_exponent_meets_the_entropy_or_the_limit_of_repeats():
    mix = fit(TOKENS, 1.0, 100, 10_000)
    assert 0 < mix.exponent < 1 and abs(entropy(weights(TOKENS, mix.exponent)) - 1.0) < 1e-5
    assert fit(TOKENS, 0.5, 100, 10_000).exponent == 1.0
    mix = fit(TOKENS, 1.09, 2.0, 10_000)
    assert abs(mix.budgets["c"] - 2_000) <= 1 and sum(mix.budgets.values()) in range(9_997, 10_001)
    assert fit(TOKENS, 1.0, 1.5).budgets["a"] >= 6_000 and min(fit(TOKENS, 1.0, 9).budgets[s] - n for s, n in TOKENS.items()) >= 0


def docs(spark, rows):
    return spark.createDataFrame([(*r, 0, 1) for r in rows], "doc_id long, source string, n long, block int, epoch int")


def test_passes_and_budgets(spark):
    rows = [(i, s, 1 + i % 50) for s, k in (("a", 6000), ("b", 900), (None, 60)) for i in range(k)]
    rows = [(j, s, n) for j, (_, s, n) in enumerate(rows)] + [(None, "b", 7), (0, "a", 1)]
    held = Counter()
    for _, s, n in rows:
        held[s or ""] += n
    budget = sum(held.values()) // 2
    got = draw(docs(spark, rows), F.col("n"), target_entropy=0.9, budget=budget, max_repeats=50).collect()
    mix = fit(held, 0.9, 50, budget)
    drawn, passes = Counter(), defaultdict(Counter)
    for r in got:
        drawn[r.source] += r.n_tokens
        passes[r.source, r.epoch][r.doc_id] += 1
    largest = max(n for *_, n in rows)
    assert all(mix.budgets[s] - largest < drawn[s] <= mix.budgets[s] for s in held)
    counts = {s: Counter(i for i, x, _ in rows if (x or "") == s) for s in held}
    for (s, e), c in passes.items():
        if e < mix.budgets[s] // held[s]:
            assert c == counts[s]
        else:
            assert all(c[i] <= counts[s][i] for i in c)
    assert drawn["a"] < held["a"] and drawn[""] > held[""]
    again = draw(docs(spark, rows).repartition(5), F.col("n"), target_entropy=0.9, budget=budget, max_repeats=50).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_a_large_source_is_cut_in_blocks(spark):
    rows = [(i, "big" if i % 3 else "small", 5000) for i in range(300)]
    got = draw(docs(spark, rows), F.col("n"), target_entropy=math.log(2) * 0.99, budget=1_500_000).collect()
    assert max(r.block_place for r in got if r.source == "big") <= 200 * 5000 // BLOCK_TOKENS
    n = sum(r.n_tokens for r in got)
    assert 1_480_000 < n <= 1_500_000


def test_edges(spark):
    assert draw(docs(spark, []), F.col("n")).collect() == []
    one = draw(docs(spark, [(1, "a", 1), (2, "a", 9)]), F.col("n")).collect()
    assert sorted((r.doc_id, r.epoch) for r in one) == [(1, 0), (2, 0)]


def test_a_source_of_any_size_keeps_its_last_token():
    held = {"a": 543_767_120_406, "b": 14_048_056_808, "c": 4_371_694_838}
    mix = fit(held, 0.6 * math.log(3), 2.0)
    assert all(mix.budgets[s] >= n for s, n in held.items())
