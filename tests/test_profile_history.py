"""Profiles that merge: exact but for distinct counts, and older rows are not read again."""

import pytest

from tidemark.operators import profile as ops
from tidemark.plans import profiles as plan
from tidemark.sources.history import append_history, read_history, staged_columns
from tidemark.sources.scan import stamp_loaded_at
from conftest import ts

TARGET = "stg.t"
EXACT = ["column_name", "total_rows", "populated", "pct_filled", "looks_timestamp", "looks_date", "looks_numeric", "min_value", "max_value"]


def add(wh, rows, schema, at):
    df = wh.spark.createDataFrame(rows, schema)
    append_history(wh, TARGET, stamp_loaded_at(df, ts(at)), df.columns)


def exact(df):
    return sorted(map(tuple, df.select(*EXACT).collect()))


def whole(wh):
    history = read_history(wh, TARGET)
    return ops.profile_columns(history.select(*staged_columns(history)), TARGET)


def test_merged_equals_whole_and_reads_new_rows_only(wh, monkeypatch):
    a = [(str(i), "2024-01-02" if i % 3 else None, "") for i in range(1000)]
    add(wh, a, "k string, d string, e string", "2024-01-01T01:00:00")
    assert exact(plan.profile_history(wh, TARGET)) == exact(whole(wh))

    seen = []
    real = plan.profile_part
    monkeypatch.setattr(plan, "profile_part", lambda rows, *a: seen.append(rows.count()) or real(rows, *a))
    b = [(str(i), "2024-01-02 10:00:00", "x") for i in range(900, 1200)]
    add(wh, b, "k string, d string, e string", "2024-01-01T02:00:00")  # the same load date grows
    merged = plan.profile_history(wh, TARGET)
    assert seen == [300] and exact(merged) == exact(whole(wh))
    distinct = {r.column_name: r.distinct_values for r in merged.collect()}
    assert abs(distinct["k"] - 1200) <= 1200 * 0.05 and distinct["d"] == 2 and distinct["e"] == 1
    assert exact(plan.profile_history(wh, TARGET)) == exact(merged) and seen == [300]  # nothing new


def test_a_column_that_joins_later_is_empty_before(wh):
    add(wh, [("a",), ("b",)], "k string", "2024-01-01")
    plan.profile_history(wh, TARGET)
    add(wh, [("c", "9")], "k string, late string", "2024-01-02")
    assert exact(plan.profile_history(wh, TARGET)) == exact(whole(wh))


def test_no_history_empty_columns_and_restart(wh):
    assert plan.profile_history(wh, TARGET) is None
    add(wh, [(None, ""), (None, "")], "n string, e string", "2024-01-01")
    profile = plan.profile_history(wh, TARGET, profiled_at=ts("2024-02-01"))
    assert [(r.populated, r.distinct_values, r.min_value) for r in profile.collect()] == [(0, 0, None)] * 2
    ops.record_profile(wh, profile.drop("profiled_at"), ts("2024-02-01"))
    assert wh.state("column_profile").count() == 2
    wh.clear(TARGET)
    add(wh, [("x", "y")], "n string, e string", "2024-01-01")
    assert exact(plan.profile_history(wh, TARGET, restart=True)) == exact(whole(wh))


@pytest.mark.parametrize("n_columns", [200])
def test_a_wide_table(spark, n_columns):
    df = spark.range(50).selectExpr(*[f"cast(id % {i + 1} as string) AS `c {i}`" for i in range(n_columns)])
    merged = ops.merge_parts(ops.profile_part(df, "w").selectExpr("*", "timestamp_ntz'2024-01-01' AS loaded_to"))
    assert exact(merged) == exact(ops.profile_columns(df, "w"))
    assert {r.column_name: r.distinct_values for r in merged.collect()} == {f"c {i}": min(i + 1, 50) for i in range(n_columns)}
