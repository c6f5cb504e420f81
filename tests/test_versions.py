import random

import pytest

from conftest import ts
from tidemark.operators.versions import latest_version, upsert_latest, written_count

COLUMNS = "k string, m timestamp_ntz, loaded_at timestamp_ntz, v int"
L1, L2, L3 = ts("2024-02-01"), ts("2024-02-02"), ts("2024-02-03")
D1, D2, D3 = ts("2024-01-01"), ts("2024-01-02"), ts("2024-01-03")


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("rows,expected", [
    ([("a", D2, L1, 1)], 1),
    ([("a", D2, L1, 1), ("a", D3, L2, 2)], 2),
    ([("a", D3, L1, 1), ("a", D2, L2, 2)], 1),
    ([("a", D2, L1, 1), ("a", D2, L2, 2)], 2),
    ([("a", None, L2, 1), ("a", D2, L1, 2)], 2),
    ([("a", None, L1, 1), ("a", None, L2, 2)], 2),
])
def test_latest_version(spark, rows, expected):
    got = latest_version(frame(spark, rows), "k", "m").collect()
    assert [r.v for r in got] == [expected]


@pytest.mark.parametrize("old,new,action,v", [
    (None, D2, "insert", 9),
    ((D2,), D2, "update", 9),
    ((D2,), D3, "update", 9),
    ((D2,), D1, "stale", 1),
    ((D2,), None, "stale", 1),
    ((None,), D1, "update", 9),
    ((None,), None, "update", 9),
])
def test_upsert_actions(spark, old, new, action, v):
    existing = frame(spark, [("z", D1, L1, 0)] + ([("a", old[0], L1, 1)] if old else []))
    out = upsert_latest(existing, frame(spark, [("a", new, L3, 9)]), "k", "m")
    rows = {r.k: r for r in out.collect()}
    assert (rows["a"].action, rows["a"].v) == (action, v)
    assert (rows["z"].action, rows["z"].v) == ("keep", 0)
    assert len(rows) == 2


@pytest.mark.parametrize("old,new,action", [
    ((D2, L3), (D2, L1), "stale"),
    ((D2, L1), (D2, L3), "update"),
    ((None, L3), (None, L1), "stale"),
    ((None, L3), (D1, L1), "update"),
    ((D2, L1), (None, L3), "stale"),
])
def test_upsert_by_load_order(spark, old, new, action):
    out = upsert_latest(frame(spark, [("a", *old, 1)]), frame(spark, [("a", *new, 9)]), "k", "m", "loaded_at")
    assert [r.action for r in out.collect()] == [action]


def random_history(seed, n=400, keys=40):
    rnd = random.Random(seed)
    days = [None] + [ts(f"2024-01-{d:02d}") for d in range(1, 8)]
    return [
        (f"k{rnd.randrange(keys)}", rnd.choice(days), ts(f"2024-02-01T{i // 60:02d}:{i % 60:02d}"), i) for i in range(n)
    ]


def state(df):
    return sorted(((r.k, r.m, r.loaded_at, r.v) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_two_batches_are_one_batch(spark, seed):
    rows = random_history(seed)
    whole = latest_version(frame(spark, rows), "k", "m")
    for cut in (1, 137, 399):
        first = latest_version(frame(spark, rows[:cut]), "k", "m")
        second = latest_version(frame(spark, rows[cut:]), "k", "m")
        merged = upsert_latest(first, second, "k", "m")
        assert state(merged) == state(whole)


def test_upsert_twice_is_once_and_counts_add_up(spark):
    rows = random_history(3)
    old = latest_version(frame(spark, rows[:200]), "k", "m")
    new = latest_version(frame(spark, rows[200:]), "k", "m")
    once = upsert_latest(old, new, "k", "m")
    twice = upsert_latest(once.drop("action"), new, "k", "m")
    assert state(once) == state(twice)
    n = written_count(once).first()
    keep = once.filter("action = 'keep'").count()
    assert n.n_written == n.n_inserted + n.n_updated
    assert n.n_inserted + n.n_updated + n.n_stale + keep == once.count()


def test_any_batch_order_gives_the_same_state_with_load_order(spark):
    rows = random_history(4)
    parts = [rows[:100], rows[100:250], rows[250:]]
    whole = state(latest_version(frame(spark, rows), "k", "m"))
    for order in ([0, 1, 2], [2, 0, 1], [2, 1, 0]):
        current = None
        for i in order:
            batch = latest_version(frame(spark, parts[i]), "k", "m")
            current = upsert_latest(current, batch, "k", "m", "loaded_at").drop("action")
        assert state(current) == whole


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr(
        "concat('k', id % 3) as k", "timestamp_ntz'2024-01-01' + make_dt_interval(id % 7) as m",
        "timestamp_ntz'2024-01-01' + make_dt_interval(id) as loaded_at", "id as v",
    )
    plan = latest_version(df, "k", "m")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "Final" in above and "Partial" in below and "WindowGroupLimit" in below
