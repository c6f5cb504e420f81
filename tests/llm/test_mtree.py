import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mtree
from tidemark.llm.mtree import top_k


def brute(rows, is_query, k, scale=1024):
    def sound(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v)

    points = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if i is not None and sound(v)]
    out = []
    for q, v in {i: v for i, v in points if is_query(i)}.items():
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in points if i != q))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, k, parts=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, node string, rank int").repartition(parts)
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, k).collect())


def test_equals_brute_force_with_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(mtree, "SUBTREE", 60)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(400)]
    rows += [(1000 + i, centres[0]) for i in range(200)]  # a third of all rows
    assert run(spark, rows, 7) == brute(rows, lambda i: i % 10 == 0, 7)


def test_queries_meet_few_subtrees_of_separate_clusters(spark, monkeypatch):
    monkeypatch.setattr(mtree, "SUBTREE", 40)
    seen, leaves, meetings = [], [], mtree._meetings

    def counted(*a, **k):
        met = meetings(*a, **k)
        seen.append(met.select("node", F.explode("queries").alias("q")).select("node", "q.query_id", "q.own").collect())
        leaves.append(a[1].select("node").subtract(a[1].select("parent")).count())
        return met

    monkeypatch.setattr(mtree, "_meetings", counted)
    rng = random.Random(5)
    centres = [[40 * rng.gauss(0, 1) for _ in range(4)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 12]]) for i in range(1800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("vec_id") % 10 == 0, 3)
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 10 == 0, 3)
    first, met = seen
    assert len(first) == len({r.query_id for r in first}) == 180
    assert all(r.node != r.own for r in met) and len({(r.node, r.query_id) for r in met}) == len(met)
    assert leaves[0] >= 45 and 4 * len(met) < 180 * leaves[0]  # of 180 queries


def test_a_block_loses_queries_at_each_node():
    import pyarrow as pa

    dim, m2 = 2, 200
    def packed(*x):
        return np.array(x, np.int32).tobytes()

    queries = [{"query_id": i, "v": packed(*v), "least": least, "own": own, "to_node": None}
               for i, (v, least, own) in enumerate([((10, 10), None, "0.9"), ((10, 10), 190, "0.9"), ((10, 10), 190, "0.0"), ((-10, -10), 190, "0.9")])]
    children = [{"node": f"0.{i}", "route": packed(*v), "radius": 1.0} for i, v in enumerate([(10, 10), (-10, -10), (10, -10)])]
    struct = pa.struct([("query_id", pa.int64()), ("v", pa.binary()), ("least", pa.int64()), ("own", pa.string()), ("to_node", pa.float64())])
    batch = pa.table({"queries": pa.array([queries], pa.list_(struct)), "route": pa.array([None], pa.binary()), "children": [children]}).to_batches()
    out = {r["node"]: [q["query_id"] for q in r["queries"]] for b in mtree._descend(m2, dim, False, iter(batch)) for r in b.to_pylist()}
    assert out == {"0.0": [0, 1], "0.1": [0, 3], "0.2": [0]}  # 2 has been there before


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (10, None), (20, [1.0, None]), (30, [float("nan"), 1.0]), (40, [float("inf"), 0.0]), (50, [2.0**21, -(2.0**22)]), (60, []), (61, [-0.0005]),
            (62, [3.0, 1.0, 2.0]), (63, [1.0, 2.0]), (63, [1.0, 2.0]), (None, [9.0, 9.0]), (70, [0.0, 0.0]), (64, [-5.0, -5.0])]
    assert run(spark, rows, 4) == brute(rows, lambda i: i % 10 == 0, 4)
    assert run(spark, rows, 100) == brute(rows, lambda i: i % 10 == 0, 100)
    assert run(spark, [], 3) == [] and run(spark, [(0, [1.0])], 3) == [] and run(spark, [(1, [1.0]), (2, [1.0])], 3) == []


def test_whole_table_against_numpy(spark):
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    v = np.floor(np.array([r.embedding for r in rows], np.float64) * 1024).astype(np.int64)
    want = []
    for i in np.flatnonzero(ids % 100 == 0):
        s = v @ v[i]
        best = [j for j in np.lexsort((ids, -s)) if j != i][:10]
        want += [(int(ids[i]), r, int(ids[j]), int(s[j])) for r, j in enumerate(best, 1)]
    assert sorted(tuple(r) for r in QUERIES["op6_mtree_top_k"](spark, sf).collect()) == sorted(want)


def test_scores_beside_a_large_norm_are_exact():
    """A page is not passed over where one rounding step of a distance is more than 1e-7."""
    import pyarrow as pa

    rng, dim, n = np.random.default_rng(0), 64, 600
    v = rng.integers(-(2**15), 2**15, (n, dim))
    v[0], v[1:200] = 0, v[1]
    v[0, 0] = 2**30 - 1
    m2 = int((v * v).sum(axis=1).max())
    table = pa.table({"vec_id": list(range(n)), "v": [x.astype(np.int32).tobytes() for x in v], "hash": list(range(n)), "node": ["0"] * n})
    tree = mtree._Subtree(mtree._build(m2, dim, table).to_pylist()[0], dim)
    for q in range(0, n, 5):
        scores = v @ v[q]
        want = [(int(scores[i]), -int(i)) for i in np.lexsort((np.arange(n), -scores)) if i != q][:10]
        for least in (None, want[-1][0]):
            assert sorted(tree.search(q, v[q], 10, least, m2), reverse=True) == want


def test_huge_vectors_are_scored_exactly(spark):
    few = [(0, [1.0, 0.5]), (1, [2.0**20, 0.0]), (2, [3.0, -4.0]), (100, [2.0**21, 1.0])]
    assert run(spark, few, 10) == brute(few, lambda i: i % 10 == 0, 10)
    assert {r[0] for r in run(spark, few, 10)} == {0, 100}
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice([0, 0, 0, 5, 5.6]) for _ in range(3)]) for i in range(300)]
    assert run(spark, rows, 6) == brute(rows, lambda i: i % 10 == 0, 6)
    alone = [(10, [2.0**20]), (20, [-(2.0**20)]), (20, [7.0])]
    assert run(spark, alone, 3) == brute(alone, lambda i: i % 10 == 0, 3)
    zero = [(10, [1e300, 0.0]), (11, [0.0, 5.0]), (12, [0.0, 1e300])]
    assert run(spark, zero, 3) == [(10, 1, 11, 0), (10, 2, 12, 0)]
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(10, [1e300, 0.0]), (11, [1.0, 0.0])], 3)
