"""Keys that changed in a reference table, found through its hash tree."""

import random

import pytest

from tidemark.operators import hash_tree as ht
from tidemark.plans import references as plan
from tidemark.sources.history import append_history
from tidemark.sources.scan import stage_text, stamp_loaded_at
from tidemark.spec import TableSpec
from conftest import ts

SPEC = TableSpec("LAW", "stg.law", ("law_id", "code", "title"), "law_id")
SCHEMA = "law_id string, code string, title string"


def seed(wh, rows, at="2024-01-01"):
    df = wh.spark.createDataFrame(rows, SCHEMA)
    append_history(wh, SPEC.target_table, stamp_loaded_at(df, ts(at)), SPEC.columns)


def found(wh, rows, **kw):
    changes = plan.reference_changes(wh, wh.spark.createDataFrame(rows, SCHEMA), SPEC, **kw)
    return {r.row_key: (r.change, r.n_before, r.n_after) for r in changes.collect()}


def expected(before, after):
    keys = {r[0] for r in before + after}
    out = {}
    for k in keys:
        a, b = (sorted(map(str, (r for r in side if r[0] == k))) for side in (before, after))
        if a != b:
            out[k] = ("added" if not a else "removed" if not b else "changed", len(a), len(b))
    return out


@pytest.mark.parametrize("rows_per_bucket", [1, 1 << 17])
def test_against_brute_force(wh, rows_per_bucket):
    rng = random.Random(5)
    before = [(f"k{i}", str(i % 7), rng.choice(["x", "", None])) for i in range(300)]
    before += [("hot", "1", "same")] * 200 + [(None, "n", "null key")]  # repeats, a hot key, a null key
    after = [r for r in before if r[0] not in ("k3", "k200")] + [("new", "1", None)]
    after = [(k, c, "edited") if k in ("k5", "k77") else (k, c, t) for k, c, t in after] + [("hot", "1", "same")]
    rng.shuffle(after)
    seed(wh, before)
    assert found(wh, after, rows_per_bucket=rows_per_bucket) == expected(before, after)
    assert found(wh, before, rows_per_bucket=rows_per_bucket) == {}


def test_null_and_empty_text_differ_and_so_do_swapped_columns(wh):
    seed(wh, [("a", None, ""), ("b", "1", "2"), (None, "x", "y")])
    got = found(wh, [("a", "", None), ("b", "2", "1"), (None, "x", "z")])
    assert got == {k: ("changed", 1, 1) for k in ("a", "b", None)}


def test_no_history_and_empty_tables(wh):
    assert found(wh, [("a", "1", "t")]) == {"a": ("added", 0, 1)}
    seed(wh, [("a", "1", "t")])
    assert found(wh, []) == {"a": ("removed", 1, 0)}


def test_only_differing_buckets_are_read(wh):
    before = [(f"k{i}", "1", "t") for i in range(500)]
    seed(wh, before)
    edited = [("k9", "1", "u") if r[0] == "k9" else r for r in before]
    tree = plan.record_reference(wh, SPEC, rows_per_bucket=4)
    n_buckets = tree.filter("level IS NULL").first().n_buckets
    assert n_buckets == 128
    other = ht.hash_tree(ht.key_digests(wh.spark.createDataFrame(edited, SCHEMA), "law_id", n_buckets))
    assert len(ht.differing_buckets(tree, other)) == 1
    changes = plan.reference_changes(wh, wh.spark.createDataFrame(edited, SCHEMA), SPEC)
    shown = changes._jdf.queryExecution().executedPlan().toString()
    assert shown.count("PartitionFilters: [isnotnull(bucket") == 2, shown
    assert [(r.row_key, r.change) for r in changes.collect()] == [("k9", "changed")]


def test_a_new_load_renews_the_tree(wh):
    seed(wh, [("a", "1", "t")])
    assert found(wh, [("a", "1", "t"), ("b", "1", "t")]) == {"b": ("added", 0, 1)}
    seed(wh, [("b", "1", "t")], at="2024-01-02")
    assert found(wh, [("a", "1", "t"), ("b", "1", "t")]) == {}


def test_column_order_and_own_columns_do_not_matter(spark):
    df = stamp_loaded_at(stage_text(spark.createDataFrame([("a", "1", "t")], SCHEMA)), ts("2024-01-01"))
    turned = df.select("title", "law_id", "code")
    assert ht.key_digests(df, "law_id", 16).collect() == ht.key_digests(turned, "law_id", 16).collect()


def test_bucket_numbers():
    assert [ht.tree_buckets(n, 10) for n in (0, 1, 160, 161)] == [16, 16, 16, 32]
    assert ht.tree_buckets(10**12) == ht.MAX_BUCKETS
