import pytest
from pyspark.sql import functions as F

from conftest import ts
from tidemark.operators.audit import load_exceptions
from tidemark.plans import facts as fplan, loads as plan
from tidemark.spec import FactSpec, Field, TableSpec

ITEMS = TableSpec("ITEMS", "stg.items", ("ID", "Name", "changed_at"), "id", "changed_at")
CODES = TableSpec("CODES", "stg.codes", ("code",), "code")
FACT = FactSpec("rep.items", "stg.items", "pk", "modified", (Field("pk", "id"), Field("modified", "changed_at", "timestamp"), Field("name", "name")), 2)


def items(spark, n, first=0):
    return spark.range(first, n).select(
        "id", F.concat(F.lit("n"), "id").alias("Name"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id)").alias("changed_at"), F.lit("ignored").alias("other"),
    )


def counts(r):
    return r.source_n, r.extracted_n, r.staged_n, r.loaded_n


def test_spec_defaults():
    assert ITEMS.staging_table == "lnd.items" and not ITEMS.is_reference
    assert TableSpec("A", "stg.a", ("x",), watermark_column="").is_reference
    for columns, watermark in ((("x", "X"), None), (("x", "loaded_at"), None), (("x",), "y")):
        with pytest.raises(ValueError):
            TableSpec("A", "stg.a", columns, watermark_column=watermark)


def test_unbounded_then_bounded_then_nothing(spark, wh):
    assert plan.load_plan(wh, ITEMS) == plan.LoadPlan("unbounded")
    first = plan.incremental_load(wh, items(spark, 5), ITEMS, ts("2023-01-01"))  # the ceiling does not bound a first load
    assert counts(first) == (5, 5, 5, 5) and not first.bounded
    assert plan.load_plan(wh, ITEMS) == plan.LoadPlan("bounded", ts("2024-01-05"))
    second = plan.incremental_load(wh, items(spark, 20), ITEMS, ts("2024-01-10"))
    assert counts(second) == (5, 5, 5, 5) and second.bounded
    assert plan.load_plan(wh, ITEMS).floor == ts("2024-01-10")
    assert counts(plan.incremental_load(wh, items(spark, 20), ITEMS, ts("2024-01-10"))) == (0, 0, 0, 0)
    history = wh.read("stg.items")
    assert history.count() == 10 and history.select("loaded_at").distinct().count() == 2
    assert dict(history.dtypes)["id"] == "string" and "other" not in history.columns


def test_two_batches_never_share_a_stamp(spark, wh):
    for _ in range(2):
        plan.incremental_load(wh, items(spark, 3 + 3 * _), ITEMS, ts("2024-02-01"), loaded_at=ts("2024-03-01"))
    assert wh.read("stg.items").select("loaded_at").distinct().count() == 2


def test_floor_is_found_by_scan_when_the_state_is_lost(spark, wh):
    plan.incremental_load(wh, items(spark, 5), ITEMS, ts("2024-02-01"))
    wh.state_row = lambda name, **key: None
    assert plan.extract_floor(wh, ITEMS) == ts("2024-01-05")


def test_rows_without_a_watermark_come_only_with_the_first_load(spark, wh):
    with_null = items(spark, 3).withColumn("changed_at", F.when(F.col("id") > 0, F.col("changed_at")))
    assert counts(plan.incremental_load(wh, with_null, ITEMS, ts("2024-02-01"))) == (3, 3, 3, 3)
    assert counts(plan.incremental_load(wh, with_null, ITEMS, ts("2024-02-01"))) == (0, 0, 0, 0)


def test_dry_run_writes_nothing(spark, wh):
    r = plan.dry_run(wh, items(spark, 5), ITEMS, ts("2024-02-01"))
    assert counts(r) == (5, 5, 0, 0)
    assert wh.read("lnd.items") is None and wh.read("stg.items") is None


def test_reference_table(spark, wh):
    codes = lambda n: spark.range(n).selectExpr("concat('c', id) as code")
    seed = plan.reference_load(wh, codes(25), CODES)
    assert (seed.mode, counts(seed)) == ("reference-seed", (25, 25, 25, 25))
    ok = plan.reference_load(wh, codes(25), CODES)
    assert (ok.mode, counts(ok)) == ("reference-ok", (25, 0, 0, 0))
    drift = plan.reference_load(wh, codes(20), CODES)
    assert (drift.mode, counts(drift)) == ("reference-drift", (20, 20, 20, 0))
    assert wh.read("stg.codes").count() == 25 and wh.read("lnd.codes").count() == 20
    assert plan.reference_load(wh, codes(21), CODES, dry_run=True).extracted_n == 0
    edited = codes(25).withColumn("code", F.when(F.col("code") == "c3", "c99").otherwise(F.col("code")))
    assert plan.reference_load(wh, edited, CODES).mode == "reference-ok"
    assert plan.reference_load(wh, edited, CODES, compare_content=True).mode == "reference-drift"
    assert plan.reference_load(wh, codes(25).repartition(5), CODES, compare_content=True).mode == "reference-ok"


def test_nightly_run(spark, wh):
    sources = {"ITEMS": items(spark, 5), "CODES": spark.range(3).selectExpr("string(id) as code")}
    one = plan.run_load(wh, sources, [ITEMS, CODES], ts("2024-02-01"), [FACT])
    assert one.status == "succeeded" and len(one.transforms) == 1
    assert wh.read_fact(FACT).count() == 5
    assert wh.fact_state("rep.items").source_as_at == ts("2024-02-01")

    sources = {"ITEMS": items(spark, 9), "CODES": spark.range(4).selectExpr("string(id) as code")}
    two = plan.run_load(wh, sources, [ITEMS, CODES], ts("2024-02-02"), [FACT], parallel=2, log_parse_errors=True)
    assert two.status == "succeeded" and wh.read_fact(FACT).count() == 9  # drift does not fail a run
    exceptions = load_exceptions(wh.current("load_run"), wh.current("load_table_run")).collect()
    assert [(r.source_table, r.status) for r in exceptions] == [("CODES", "drift")]

    sources["ITEMS"] = items(spark, 12).drop("Name")
    three = plan.run_load(wh, sources, [CODES, ITEMS], ts("2024-02-03"), [FACT])
    assert three.status == "failed" and three.error == "tables failed: ITEMS"
    assert set(three.tables) == {"CODES"} and wh.read_fact(FACT).count() == 9
    runs = {r.run_id: r.status for r in wh.current("load_run").collect()}
    assert runs == {one.run_id: "succeeded", two.run_id: "succeeded", three.run_id: "failed"}
    failed = wh.current("load_table_run").filter("status = 'failed'").first()
    assert "Name" in failed.error_message and failed.watermark_from == ts("2024-01-09")


def test_dry_run_of_a_whole_night(spark, wh):
    r = plan.run_load(wh, {"ITEMS": items(spark, 5)}, [ITEMS], ts("2024-02-01"), [FACT], dry_run=True)
    assert r.status == "succeeded" and wh.read("stg.items") is None and wh.read_fact(FACT) is None
    assert load_exceptions(wh.current("load_run"), wh.current("load_table_run")).isEmpty()


def test_failed_transform_keeps_the_loads(spark, wh):
    broken = FactSpec("rep.x", "stg.items", "pk", "m", (Field("pk", "nope"), Field("m", "changed_at", "timestamp")))
    r = plan.run_load(wh, {"ITEMS": items(spark, 5)}, [ITEMS], ts("2024-02-01"), [broken])
    assert r.status == "failed" and r.error.startswith("loaded, but transform failed")
    assert wh.read("stg.items").count() == 5
    assert plan.run_load(wh, {"ITEMS": items(spark, 5)}, [ITEMS], ts("2024-02-02"), [FACT]).status == "succeeded"
    assert wh.read_fact(FACT).count() == 5


def test_failed_hop():
    hop = lambda *c: plan.LoadResult(*c, "normal").failed_hop()
    assert hop(10, 10, 10, 10, True) == "none" and hop(11, 10, 10, 10, True) == "fetch"
    assert hop(11, 10, 10, 10, False) == "none" and hop(10, 10, 9, 9, True) == "land" and hop(10, 10, 10, 9, False) == "append"
