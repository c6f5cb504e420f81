import pytest

from conftest import ts
from tidemark.operators import audit as a, probe as pr, quality as q

NOW = ts("2024-03-02T12:00:00")


def test_reconcile_names_the_hop(spark):
    cases = [(True, 10, 10, 10, 10, "none"), (True, 11, 10, 10, 10, "fetch"), (False, 11, 10, 10, 10, "none"),
             (True, 10, 10, 9, 9, "land"), (True, 10, 10, 10, 9, "append"), (True, None, 10, 10, 10, "fetch"),
             (False, None, None, None, None, "none")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)],
                               "i int, bounded boolean, source_n long, extracted_n long, staged_n long, loaded_n long, want string")
    for r in a.reconcile(df).collect():
        assert r.failed_hop == r.want and r.reconciled == (r.want == "none")


RUNS = "run_id string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, error_message string, dry_run boolean"
TABLES = ("run_id string, source_table string, watermark_from timestamp_ntz, source_row_count long, extracted_row_count long, "
          "staged_row_count long, loaded_row_count long, status string, error_message string")


def test_load_exceptions(spark):
    runs = spark.createDataFrame([
        ("ok", NOW, NOW, "succeeded", None, False), ("dry", NOW, NOW, "succeeded", None, True),
        ("early", NOW, NOW, "failed", "no source", False), ("odd", NOW, NOW, "failed", "tables failed", None),
        ("quiet", NOW, NOW, "succeeded", None, False),
    ], RUNS)
    tables = spark.createDataFrame([
        ("ok", "bounded", NOW, 5, 5, 5, 5, "succeeded", None), ("ok", "unbounded", None, 6, 5, 5, 5, "succeeded", None),
        ("ok", "drifted", None, 6, 6, 6, 0, "drift", "drift"), ("dry", "t", NOW, 5, 5, 0, 0, "succeeded", None),
        ("odd", "fetch", NOW, 6, 5, 5, 5, "failed", None), ("odd", "null", NOW, None, None, None, None, "failed", "boom"),
    ], TABLES)
    got = {(r.run_id, r.source_table): r.error_message for r in a.load_exceptions(runs, tables).collect()}
    assert got == {("ok", "drifted"): "drift", ("early", None): "no source", ("odd", "fetch"): "tables failed", ("odd", "null"): "boom"}


def test_monitors(spark):
    runs = spark.createDataFrame([
        ("a", ts("2024-03-02T05:59:59"), None, "running", None, False),
        ("b", ts("2024-03-02T06:00:00"), None, "running", None, False),
        ("c", NOW, ts("2024-03-01T10:00:00"), "succeeded", None, False),
        ("d", NOW, ts("2024-03-02T10:00:00"), "succeeded", None, True),
    ], RUNS)
    assert [r.run_id for r in a.stalled_runs(runs, NOW).collect()] == ["a"]
    assert tuple(a.heartbeat(runs, NOW).first()) == (ts("2024-03-01T10:00:00"), 26 * 3600, False)
    assert a.heartbeat(runs, ts("2024-03-02T12:00:01")).first().overdue is True
    assert tuple(a.heartbeat(runs.limit(0), NOW).first()) == (None, None, True)
    wm = spark.createDataFrame([("rep.f", "stg.t", ts("2024-03-01T10:00:00.5"), ts("2024-03-01"))],
                               "target_table string, source_table string, last_loaded_at timestamp_ntz, source_as_at timestamp_ntz")
    lag = a.transform_lag(wm, NOW).first()
    assert (lag.lag_seconds, lag.overdue) == (26 * 3600 - 1, False)
    currency = a.data_currency(wm, ts("2024-03-03")).first()
    assert (currency.as_at, currency.stale) == (ts("2024-03-01"), True)
    arrivals = spark.createDataFrame([("stg.t", ts("2024-03-01")), ("stg.t", NOW), ("stg.t", NOW)], "source_table string, loaded_at timestamp_ntz")
    assert a.pending_rows(wm, arrivals).first().pending_rows == 2
    assert a.pending_rows(wm, arrivals.limit(0)).first().pending_rows == 0


def test_run_outcome(spark):
    t = spark.createDataFrame([("1", "b", "failed"), ("1", "a", "failed"), ("2", "a", "drift"), ("3", "a", "succeeded")],
                              "run_id string, source_table string, status string")
    x = spark.createDataFrame([("3", "disk full"), ("2", None)], "run_id string, transform_error string")
    got = {r.run_id: (r.status, r.error_message) for r in a.run_outcome(t, x).collect()}
    assert got == {"1": ("failed", "tables failed: a, b"), "2": ("succeeded", None),
                   "3": ("failed", "loaded, but transform failed: disk full")}
    assert a.run_outcome(t).filter("status = 'failed'").count() == 1


@pytest.mark.parametrize("state,message,status,code", [
    ("08S01", "Communication link failure", "link", None), ("HY000", "a link failure (100)", "link", 100),
    ("HY000", "else (100)", "missing", 100), ("HYT00", "anything (100)", "timeout", 100), ("HYT01", None, "timeout", None),
    ("42000", "gone (100)", "missing", 100), ("42000", "gone  (802)  (SQLExecDirectW) ", "missing", 802),
    ("42000", "layout (105)", "missing", 105), ("42000", "x (204)", "denied", 204), ("42000", "x (212)", "denied", 212),
    ("42000", "access denied (101)", "error", 101), ("42000", "Not Permitted (9) (SQLExecDirectW)", "denied", 9),
    ("42000", "(100) not at the end", "error", None), (None, None, "error", None),
])
def test_probe_classify(spark, state, message, status, code):
    r = pr.probe_classify(spark.createDataFrame([(state, message)], "sqlstate string, message string")).first()
    assert (r.status, r.native_error) == (status, code)
    assert r.message is None or "  " not in r.message


def test_catalog_like(spark):
    names = spark.createDataFrame([("PP_Charges",), ("charge_list",), ("xCHARgey",), ("other",)], "table_name string")
    got = lambda p: sorted(r[0] for r in pr.catalog_like(names, p).collect())
    assert got("charge") == ["PP_Charges", "charge_list", "xCHARgey"]
    assert got("%charge_l") == ["charge_list"]
    assert got("^char") == ["charge_list"]


def test_probe_latest_is_per_table(spark):
    p = spark.createDataFrame([("a", ts("2024-01-01"), True), ("a", ts("2024-01-02"), False), ("b", ts("2024-01-01"), True)],
                              "source_table string, probed_at timestamp_ntz, readable boolean")
    assert {(r.source_table, r.readable) for r in pr.probe_latest(p).collect()} == {("a", False), ("b", True)}


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "fk string")
    parent = spark.createDataFrame([("y",), ("y",)], "pk string")
    assert q.orphan_rows(child, "fk", parent, "pk").count() == 2
    assert tuple(q.orphan_keys(child, "fk", parent, "pk").first()) == ("x", 2)
    assert tuple(q.orphan_count(child, "fk", parent, "pk").first()) == (2, 1)
    assert tuple(q.orphan_count(child.limit(0), "fk", parent, "pk").first()) == (0, 0)
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, t int")
    assert [tuple(r) for r in q.duplicate_keys(rows, ["k", "t"]).collect()] == [("a", 1, 2)]


def test_orphans_are_counted_per_key_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = q.orphan_keys(spark.range(9).selectExpr("id % 3 as fk"), "fk", spark.range(2).selectExpr("id as pk"), "pk")
        plan = keys._jdf.queryExecution().executedPlan().toString()
        assert plan.index("SortMergeJoin") < plan.index("HashAggregate") and [tuple(r) for r in keys.collect()] == [(2, 3)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reference_diff_treats_nulls_as_equal_and_skips_loaded_at(spark):
    landed = spark.createDataFrame([("1", None, NOW), ("2", "b", NOW), ("2", "b", NOW)], "id string, v string, loaded_at timestamp_ntz")
    history = spark.createDataFrame([("1", None, ts("2024-01-01")), ("3", "c", NOW)], "id string, v string, loaded_at timestamp_ntz")
    assert {tuple(r) for r in q.reference_diff(landed, history).collect()} == {("landed_only", "2", "b"), ("history_only", "3", "c")}


def test_reference_check_and_hash(spark):
    r = spark.range(25)
    mode = lambda s, h: q.reference_check(s, h).first().mode
    assert mode(r, r.limit(0)) == "reference-seed" and mode(r, r) == "reference-ok" and mode(r, r.limit(20)) == "reference-drift"
    pairs = spark.createDataFrame([("a",), ("a",)], "v string"), spark.createDataFrame([("b",), ("b",)], "v string")
    assert q.content_hash(pairs[0]).first() != q.content_hash(pairs[1]).first()
    swapped = [spark.createDataFrame([r], "a string, b string") for r in (("x", None), (None, "x"))]
    assert q.content_hash(swapped[0]).first() != q.content_hash(swapped[1]).first()
    assert tuple(q.parity_check(r, r.limit(3)).first()) == (25, 3, False)


def test_domains(spark):
    df = spark.createDataFrame([(1, "ok", "x"), (2, "bad", None), (3, None, "x")], "id int, status string, need string")
    got = {tuple(r) for r in q.domain_violations(df, {"status": ("ok",)}, ["need"], ["id"]).collect()}
    assert got == {(2, "status", "bad", "not allowed"), (2, "need", None, "missing")}
