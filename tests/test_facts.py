import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import ts
from tidemark.plans import facts as plan
from tidemark.sources.history import append_history
from tidemark.sources.store import bucket_of
from tidemark.spec import FactSpec, Field
from tidemark.streaming import stream_transform

SPEC = FactSpec("rep.f", "stg.t", "pk", "modified", (
    Field("pk", "key"), Field("modified", "mod", "timestamp"), Field("amount", "amt", "numeric"),
    Field("flag", "f", "flag"), Field("at", "clock", "clock"),
), n_buckets=4)
OTHER = FactSpec("rep.g", "stg.u", "pk", "modified", (Field("pk", "key"), Field("modified", "mod", "timestamp")), n_buckets=2)
L1, L2, L3 = ts("2024-02-01"), ts("2024-02-02"), ts("2024-02-03")
NOW = ts("2024-03-01")


def history(spark, rows):
    """(key, mod, amount, loaded_at)"""
    return spark.createDataFrame(
        [(k, m, a, "x" if a else "", "9:05", at) for k, m, a, at in rows],
        "key string, mod string, amt string, f string, clock string, loaded_at timestamp_ntz",
    )


def add(wh, rows, spec=SPEC):
    append_history(wh, spec.source_table, history(wh.spark, rows), spec.source_columns)


def fact(wh, spec=SPEC):
    df = wh.read_fact(spec)
    return {} if df is None else {r.pk: r for r in df.collect()}


def test_projection_types(spark):
    row = plan.project_fact(history(spark, [("a", "2024-01-02", "11136.0", L1)]), SPEC).first()
    assert tuple(row) == ("a", ts("2024-01-02"), Decimal(11136), True, "09:05:00", L1)
    assert len(plan.incident_fact("k").fields) == 24 and len(plan.charge_fact("k").fields) == 17


def test_spec_refuses_unknown_names():
    with pytest.raises(ValueError):
        FactSpec("t", "s", "missing", "m", (Field("m", "m"),))
    with pytest.raises(ValueError):
        Field("a", "a", "integer")
    with pytest.raises(ValueError, match="reserved"):
        FactSpec("t", "s", "k", "m", (Field("k", "k"), Field("m", "m"), Field("bucket", "b")))


def test_transform_over_three_batches(wh):
    assert plan.transform(wh, SPEC).outcome == "skipped"
    add(wh, [("a", "2024-01-02", "1", L1), ("b", "2024-01-02", "1", L1), (None, "2024-01-02", "1", L1)])
    first = plan.transform(wh, SPEC, now=NOW, source_as_at=L1)
    assert (first.row["n_batch"], first.row["n_nokey"], first.row["n_written"]) == (3, 1, 2)

    again = plan.transform(wh, SPEC, source_as_at=L3)
    assert again.outcome == "nothing new" and again.row is None
    assert wh.fact_state(SPEC.target_table).source_as_at == L1  # does not advance on an empty batch

    add(wh, [("a", "2024-01-03", "2", L2), ("a", "2024-01-04", "3", L2), ("b", "2024-01-01", "9", L2), ("c", "junk", "", L2)])
    second = plan.transform(wh, SPEC, now=ts("2024-03-02"), source_as_at=L2)
    assert second.counts["insert"] == 1 and second.counts["update"] == 1 and second.counts["stale"] == 1
    assert second.row["n_written"] == 2
    rows = fact(wh)
    assert (rows["a"].amount, rows["b"].amount, rows["c"].modified) == (3, 1, None)
    assert rows["c"].flag is False
    assert (rows["a"].transformed_at, rows["b"].transformed_at) == (ts("2024-03-02"), NOW)

    add(wh, [("c", None, "7", L3), ("b", None, "8", L3)])
    plan.transform(wh, SPEC, now=NOW)
    rows = fact(wh)
    assert (rows["c"].amount, rows["b"].amount) == (7, 1)
    assert wh.fact_state(SPEC.target_table).last_loaded_at == L3


def test_only_touched_buckets_are_rewritten(wh):
    add(wh, [(f"k{i}", "2024-01-02", "1", L1) for i in range(50)])
    plan.transform(wh, SPEC)
    assert wh.fact_state(SPEC.target_table).bucket_versions == [1, 1, 1, 1]
    add(wh, [("k7", "2024-01-03", "2", L2)])
    plan.transform(wh, SPEC)
    versions = wh.fact_state(SPEC.target_table).bucket_versions
    assert sorted(versions) == [1, 1, 1, 2]
    rows = fact(wh)
    assert len(rows) == 50 and rows["k7"].amount == 2


def test_one_file_per_bucket(wh):
    add(wh, [(f"k{i}", "2024-01-02", "1", L1) for i in range(200)])
    plan.transform(wh, SPEC)
    assert len(wh.read_fact(SPEC).inputFiles()) == 4


def test_a_first_version_is_exchanged_once(wh, monkeypatch):
    rows = [(f"k{i}", "2024-01-02", str(i), L1) for i in range(200)] + [("hot", f"2024-01-{d:02}", str(d), L1) for d in range(1, 29)]
    add(wh, [*rows, ("hot", "2024-01-28", "99", L2), (None, "2024-01-02", "1", L1), ("", "2024-01-02", "5", L1)])
    monkeypatch.setattr(plan, "HOT_ROWS", 9)  # above it the latest version is found before rows are dealt to a bucket
    dealt, seen = plan._latest_fact, []
    monkeypatch.setattr(plan, "_latest_fact", lambda *a: seen.append(a[3:]) or dealt(*a))
    done = plan.transform(wh, SPEC)
    assert seen == [((4, ["hot"]),)] and (done.row["n_batch"], done.row["n_nokey"], done.row["n_written"]) == (231, 1, 202)
    assert not os.path.exists(wh.path("rep.f_batch")) and len(wh.read_fact(SPEC).inputFiles()) == 4
    files = wh.spark.read.parquet(f"{wh.path('rep.f')}/v=1")
    assert files.filter(bucket_of(F.col("pk"), 4) != F.col("bucket")).count() == 0
    expected = {r.pk: r.amount for r in plan.rebuild(wh.read("stg.t"), SPEC, tiebreak=True).collect()}
    assert {k: r.amount for k, r in fact(wh).items()} == expected and expected["hot"] == 99 and expected[""] == 5


def test_a_first_version_with_numbers_for_keys(spark, wh, monkeypatch):
    monkeypatch.setattr(plan, "HOT_ROWS", 9)
    rows = spark.sql("select if(id < 30, id, if(id < 45, 7, null)) as key, '2024-01-02' as mod, timestamp_ntz'2024-02-01' as loaded_at from range(50)")
    append_history(wh, "stg.u", rows, ["key", "mod"])
    plan.transform(wh, OTHER)
    assert sorted(fact(wh, OTHER)) == list(range(30))


def test_many_versions_are_found_before_they_are_dealt(wh):
    add(wh, [(f"k{i % 9}", f"2024-01-{i // 9 + 1:02}", str(i), L1) for i in range(90)])
    plan.transform(wh, SPEC)
    assert {r.amount for r in fact(wh).values()} == set(range(81, 90))
    assert not os.path.exists(f"{wh.path('rep.f_batch')}/v=1")  # merged, so it is not needed any more


def test_rows_of_one_date_are_not_sorted(wh, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    seen, part = [], DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: seen.append(self._df) or part(self, *c))
    add(wh, [("a", "2024-01-02", "1", L1), ("b", "2024-01-02", "1", ts("2024-02-01 09:00:00"))])
    add(wh, [("c", "2024-01-02", "1", L2), ("d", "2024-01-02", "1", L3)])
    add(wh, [("e", "2024-01-02", "1", L3), ("f", "2024-01-02", "1", None)])
    add(wh, [])
    fixed = ["to_date(loaded_at" not in df._jdf.queryExecution().analyzed().toString() for df in seen]
    assert fixed == [True, False, False, False]
    got = {r.key: r.load_date and r.load_date.isoformat() for r in wh.read("stg.t").collect()}
    assert got == {"a": "2024-02-01", "b": "2024-02-01", "c": "2024-02-02", "d": "2024-02-03", "e": "2024-02-03", "f": None}


def test_expired_versions_are_deleted(wh):
    for i in range(3):
        add(wh, [("k7", f"2024-01-0{i + 1}", str(i), ts(f"2024-02-0{i + 1}"))] + [(f"x{j}", "2024-01-01", "1", L1) for j in range(20) if i == 0])
        plan.transform(wh, SPEC)
    assert len(wh.expire_versions(SPEC, keep=3)) == 0
    gone = wh.expire_versions(SPEC, keep=1)
    assert len(gone) == 2 and len({g.split("/")[1] for g in gone}) == 1
    assert len(fact(wh)) == 21 and fact(wh)["k7"].amount == 2


def test_bucket_count():
    mb = 1 << 20
    assert plan.bucket_count(0) == 1 and plan.bucket_count(1000 * mb, 0, 10 * mb) == 100
    assert plan.bucket_count(80 * mb, 4, 10 * mb) == 4 and plan.bucket_count(81 * mb, 4, 10 * mb) == 9


def test_tasks_stay_bounded_when_buckets_do_not(spark, wh, monkeypatch):
    assert plan.bucket_count(5000 << 20, 0, 1 << 20) == 5120 and plan.bucket_tasks(5120) == plan.BUCKET_TASKS
    assert [plan.bucket_tasks(n) for n in (1, 7, 1024, 5000)] == [1, 7, 1024, 5000]
    monkeypatch.setattr(plan, "BUCKET_TASKS", 2)
    spec = FactSpec("rep.many", "stg.t", *[getattr(SPEC, a) for a in ("key", "modified", "fields")])
    add(wh, [(f"k{i}", "2024-01-02", str(i), L1) for i in range(50)])
    plan.transform(wh, spec, bucket_bytes=500)
    first = len(wh.fact_state(spec.target_table).bucket_versions)
    add(wh, [(f"k{i}", "2024-01-03", str(i + 1), L2) for i in range(40, 300)])
    plan.transform(wh, spec, bucket_bytes=500)
    n = len(wh.fact_state(spec.target_table).bucket_versions)
    assert first > 2 and n > 2 * first and n % 2 == 0
    files = spark.read.option("basePath", wh.path(spec.target_table)).parquet(f"{wh.path(spec.target_table)}/v=2")
    assert files.select("pk", "bucket").filter(bucket_of(F.col("pk"), n) != F.col("bucket")).count() == 0
    assert files.select(F.input_file_name()).distinct().count() == files.select("bucket").distinct().count()
    assert {r.pk: r.amount for r in wh.read_fact(spec).collect()} == {f"k{i}": i + (i >= 40) for i in range(300)}


def test_rows_are_typed_before_they_are_exchanged(wh):
    add(wh, [("a", "2024-01-02", "1", L1), ("a", "2024-01-03", "2", L1), ("b", "x", "y", L1)])
    found = plan.rebuild(wh.read("stg.t"), SPEC, tiebreak=True)
    above, exchange = found._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)
    assert "RLIKE" not in above.upper() and exchange.upper().count("RLIKE") > 0
    assert {r.pk: r.amount for r in found.collect()} == {"a": 2, "b": None}


def test_keys_are_told_apart_by_their_text(wh):
    spec = FactSpec("rep.n", "stg.t", "pk", "modified", (Field("pk", "key", "numeric"), Field("modified", "mod"), Field("amount", "amt", "numeric")))
    add(wh, [("1", "2024-01-02", "1", L1), ("1.0", "2024-01-02", "2", L1), ("1", "2024-1-3", "3", L1), ("1", "later", "4", L1)])
    assert sorted((int(r.pk), int(r.amount), r.modified) for r in plan.rebuild(wh.read("stg.t"), spec).collect()) == [(1, 2, "2024-01-02"), (1, 3, "2024-1-3")]


def test_buckets_follow_the_fact(spark, wh):
    spec = FactSpec("rep.grown", "stg.t", *[getattr(SPEC, a) for a in ("key", "modified", "fields")])
    add(wh, [("first", "2024-01-02", "1", L1)])
    plan.transform(wh, spec, bucket_bytes=2000)
    assert len(wh.fact_state(spec.target_table).bucket_versions) == 1
    add(wh, [(f"k{i}", "2024-01-02", str(i), L2) for i in range(300)])
    plan.transform(wh, spec, bucket_bytes=2000)
    grown = len(wh.fact_state(spec.target_table).bucket_versions)
    assert grown > 4 and wh.read_fact(spec).count() == 301
    add(wh, [("k7", "2024-01-03", "99", L3)])
    plan.transform(wh, spec, bucket_bytes=2000)
    state = wh.fact_state(spec.target_table)
    assert len(state.bucket_versions) == grown and state.bucket_versions.count(3) == 1
    rows = {r.pk: r for r in wh.read_fact(spec).collect()}
    assert len(rows) == 301 and rows["k7"].amount == 99 and rows["first"].amount == 1
    plan.rebuild_fact(wh, spec, bucket_bytes=1 << 30)
    state = wh.fact_state(spec.target_table)
    assert state.bucket_versions == [4] and state.last_loaded_at == L3
    assert {r.pk: r.amount for r in wh.read_fact(spec).collect()} == {k: r.amount for k, r in rows.items()}


def test_transform_after_a_watermark_without_a_snapshot(wh):
    plan.advance_transform_watermark(wh, SPEC.target_table, SPEC.source_table, L1)
    add(wh, [("a", "2024-01-02", "1", L1), ("b", "2024-01-02", "2", L2)])
    assert plan.transform(wh, SPEC).outcome == "transformed" and set(fact(wh)) == {"b"}


def test_uncommitted_version_is_invisible_and_redone(wh):
    add(wh, [("a", "2024-01-02", "1", L1)])
    plan.transform(wh, SPEC)
    add(wh, [("a", "2024-01-03", "2", L2)])
    prepared = plan.prepare_transform(wh, SPEC)  # written, then the run dies
    assert prepared.outcome == "transformed" and fact(wh)["a"].amount == 1
    plan.transform(wh, SPEC)
    assert fact(wh)["a"].amount == 2 and wh.fact_state(SPEC.target_table).version == 2


def test_run_transforms_is_all_or_nothing(wh):
    add(wh, [("a", "2024-01-02", "1", L1)])
    add(wh, [("a", "2024-01-02", "1", L1)], OTHER)
    broken = FactSpec("rep.h", "stg.t", "pk", "m", (Field("pk", "no such column"), Field("m", "mod", "timestamp")))
    with pytest.raises(Exception, match="no such column"):
        plan.run_transforms(wh, [SPEC, OTHER, broken])
    assert fact(wh) == {} and fact(wh, OTHER) == {}
    plan.run_transforms(wh, [SPEC, OTHER], source_as_at=NOW)
    assert len(fact(wh)) == len(fact(wh, OTHER)) == 1
    assert len([f for f in os.listdir(f"{wh.root}/elt/transform_watermark") if f.endswith(".parquet")]) == 1


def test_as_at_defaults_to_the_newest_real_success(wh):
    wh.append_state("load_run", [
        {"run_id": "1", "status": "succeeded", "watermark_to": L1, "event_at": L1, "event_seq": 1},
        {"run_id": "2", "status": "succeeded", "watermark_to": L3, "dry_run": True, "event_at": L3, "event_seq": 1},
        {"run_id": "3", "status": "failed", "watermark_to": L3, "event_at": L3, "event_seq": 1},
    ])
    add(wh, [("a", "2024-01-02", "1", L1)])
    assert plan.transform(wh, SPEC).row["source_as_at"] == L1
    moved = plan.transform(wh, SPEC, source_as_at=L2, advance_as_at=True)
    assert moved.outcome == "nothing new" and wh.fact_state(SPEC.target_table).source_as_at == L2
    assert len(fact(wh)) == 1


def test_batch_with_no_key_at_all(wh):
    add(wh, [(None, "2024-01-02", "1", L1)])
    assert plan.transform(wh, SPEC).row["n_written"] == 0
    add(wh, [(None, "2024-01-02", "1", L2)])
    plan.transform(wh, SPEC)
    add(wh, [("a", "2024-01-02", "1", L3)])
    plan.transform(wh, SPEC)
    assert set(fact(wh)) == {"a"}


def test_rebuild_equals_transform_from_empty(wh):
    rows = [(f"k{i % 7}", [None, "x", "2024-01-02", "2024-01-05"][i % 4], str(i), ts(f"2024-02-01T00:{i:02d}")) for i in range(50)]
    add(wh, rows)
    plan.transform(wh, SPEC)
    expected = {r.pk: r.amount for r in plan.rebuild(wh.read("stg.t"), SPEC).collect()}
    assert {k: r.amount for k, r in fact(wh).items()} == expected


def test_parse_errors_are_recorded(wh):
    add(wh, [("a", "junk", "two", L1), ("b", "2024-01-02", "1", L1)])
    plan.record_parse_errors(wh, SPEC, "run1", None, L1, NOW)
    got = {(r.row_key, r.source_column, r.raw_value, r.error_type, r.run_id) for r in wh.state("parse_errors").collect()}
    assert got == {("a", "mod", "junk", "not a timestamp", "run1"), ("a", "amt", "two", "not a numeric", "run1")}


def run_stream(wh, **kw):
    stream_transform(wh, SPEC, f"{wh.root}/cp", **kw).awaitTermination()


def test_stream_equals_rebuild_in_any_file_order(spark, wh):
    rows = [(f"k{i % 11}", [None, "2024-01-02", "2024-01-02", "2024-01-05"][i % 4], str(i + 1), ts(f"2024-02-01T{i // 60:02d}:{i % 60:02d}"))
            for i in range(120)]
    for part in (rows[80:], rows[:40], rows[40:80]):  # newest first
        add(wh, part)
    run_stream(wh, max_files=1)
    expected = {r.pk: r.amount for r in plan.rebuild(wh.read("stg.t"), SPEC).collect()}
    assert {k: r.amount for k, r in fact(wh).items()} == expected
    version = wh.fact_state(SPEC.target_table).version
    run_stream(wh)
    assert wh.fact_state(SPEC.target_table).version == version  # unchanged files deliver nothing
    add(wh, [("k1", "2024-01-09", "999", ts("2024-02-02"))])
    run_stream(wh)
    assert fact(wh)["k1"].amount == 999


def test_stream_recognises_a_replayed_batch(wh, monkeypatch):
    import tidemark.streaming.transform as st

    add(wh, [("a", "2024-01-02", "1", L1)])
    real = st.commit

    def dies_after_commit(w, prepared):
        real(w, prepared)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(st, "commit", dies_after_commit)
    with pytest.raises(Exception):
        run_stream(wh)
    monkeypatch.setattr(st, "commit", real)
    assert wh.fact_state(SPEC.target_table).version == 1
    run_stream(wh)
    assert wh.fact_state(SPEC.target_table).version == 1 and fact(wh)["a"].amount == 1
