"""The run audit of streams."""

import pytest

from conftest import ts
from tidemark.operators.audit import heartbeat, load_exceptions, stalled_runs
from tidemark.sources.history import append_history
from tidemark.sources.scan import stamp_loaded_at
from tidemark.spec import FactSpec, Field
from tidemark.streaming import audited_stream

SPEC = FactSpec("rep.f", "stg.t", "pk", "modified", (
    Field("pk", "pk"), Field("modified", "mod", "timestamp"), Field("amount", "amt", "numeric"),
), n_buckets=2)
COUNTS = ["source_row_count", "extracted_row_count", "staged_row_count", "loaded_row_count"]


def add(wh, rows, at):
    df = wh.spark.createDataFrame(rows, "pk string, mod string, amt string")
    append_history(wh, "stg.t", stamp_loaded_at(df, ts(at)), df.columns)


def run(wh, **kw):
    stream = audited_stream(wh, SPEC, f"{wh.root}/cp", **kw)
    stream.await_termination()
    return stream.run_id


def row(wh, run_id):
    return wh.current("load_table_run").filter(f"run_id = '{run_id}'").first()


def test_counts_of_all_batches_reconcile(wh):
    add(wh, [(f"k{i % 7}", "2024-01-02", str(i)) for i in range(40)] + [(None, None, "1")], "2024-02-01")
    add(wh, [("k1", "2024-01-03", "5")], "2024-02-02")
    first = run(wh, max_files=1)  # several micro-batches
    got = row(wh, first)
    assert [got[c] for c in COUNTS] == [42] * 4 and got.status == "succeeded" and got.watermark_from is None
    assert wh.read_fact(SPEC).count() == 7
    add(wh, [("k1", "2024-01-04", "6")] * 3, "2024-02-03")
    second = row(wh, run(wh))
    assert [second[c] for c in COUNTS] == [3] * 4 and second.watermark_from == ts("2024-02-02")
    nothing = row(wh, run(wh))
    assert [nothing[c] for c in COUNTS] == [0] * 4 and nothing.status == "succeeded"
    runs, tables = wh.current("load_run"), wh.current("load_table_run")
    assert load_exceptions(runs, tables).count() == 0
    assert {(r.status, r.trigger_source) for r in runs.collect()} == {("succeeded", "stream")}
    assert heartbeat(runs, ts("2100-01-01")).first().overdue


def test_a_stream_that_fails_is_an_exception_and_a_replay_counts_nothing(wh, monkeypatch):
    import tidemark.streaming.audit as sa

    add(wh, [("a", "2024-01-02", "1")], "2024-02-01")
    real = sa.commit

    def dies_after_commit(w, prepared):
        real(w, prepared)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sa, "commit", dies_after_commit)
    with pytest.raises(Exception):
        run(wh)
    monkeypatch.setattr(sa, "commit", real)
    runs, tables = wh.current("load_run"), wh.current("load_table_run")
    wrong = load_exceptions(runs, tables).collect()
    assert [r.status for r in wrong] == ["failed"] and "driver lost" in wrong[0].error_message
    assert stalled_runs(runs, ts("2100-01-01")).count() == 0
    again = row(wh, run(wh))
    assert [again[c] for c in COUNTS] == [0] * 4 and again.status == "succeeded"
    assert wh.read_fact(SPEC).count() == 1


def test_without_history_no_run_is_recorded(wh):
    with pytest.raises(ValueError):
        audited_stream(wh, SPEC, f"{wh.root}/cp")
    assert wh.state("load_run").count() == 0
