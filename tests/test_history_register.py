"""The register of a history's columns, its typed watermark, and text sources."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.windows import high_watermark
from tidemark.plans.facts import record_refused_lines
from tidemark.plans.loads import extract_floor, incremental_load
from tidemark.sources.history import append_history, read_history, staged_columns, watermark_range
from tidemark.sources.scan import scan_text, stamp_loaded_at
from tidemark.spec import TableSpec

from conftest import ts

def explained(df) -> str:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


SPEC = TableSpec("T", "stg.t", ("id", "changed"), "id", "changed")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id string, changed string")


def test_bounds_reach_the_scan_and_no_text_is_parsed(spark, wh):
    source = rows(spark, ("1", "2024-01-01 10:00:00"), ("2", "2024-01-02"), ("3", "not a time"), ("4", None))
    incremental_load(wh, source, SPEC, ts("2024-02-01"), loaded_at=ts("2024-02-02"))
    history = read_history(wh, "stg.t")
    assert staged_columns(history) == ["id", "changed"]
    found = watermark_range(history, "changed", ts("2024-01-01T09:00:00"), ts("2024-01-01T23:00:00"))
    plan = explained(found)
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThan(_wm,2024-01-01T09:00)" in pushed and "LessThanOrEqual(_wm,2024-01-01T23:00)" in pushed
    assert [r.id for r in found.collect()] == ["1"]
    newest = high_watermark(history, "changed")
    assert "RLIKE" not in explained(newest).upper() and newest.first()[0] == ts("2024-01-02")
    wh.clear("elt.extract_watermark")
    assert extract_floor(wh, SPEC) == ts("2024-01-02")


def test_a_load_without_new_columns_leaves_the_register(spark, wh):
    for day in (1, 2, 3):
        append_history(wh, "stg.t", stamp_loaded_at(rows(spark, (str(day), f"2024-01-0{day}")), ts(f"2024-02-0{day}")), ["id", "changed"], "changed")
    assert wh.state("history_columns").count() == 1
    grown = rows(spark, ("4", "2024-01-04")).withColumn("more", F.lit("m"))
    append_history(wh, "stg.t", stamp_loaded_at(grown, ts("2024-02-04")), ["id", "changed", "more"], "changed")
    assert wh.state("history_columns").count() == 2
    history = read_history(wh, "stg.t")
    assert staged_columns(history) == ["id", "changed", "more"]
    assert sorted((r.id, r.more) for r in history.collect()) == [("1", None), ("2", None), ("3", None), ("4", "m")]


def test_a_history_that_was_not_always_typed_parses_its_text(spark, wh):
    append_history(wh, "stg.t", stamp_loaded_at(rows(spark, ("1", "2024-01-05")), ts("2024-02-01")), ["id", "changed"])
    append_history(wh, "stg.t", stamp_loaded_at(rows(spark, ("2", "2024-01-02")), ts("2024-02-02")), ["id", "changed"], "changed")
    history = read_history(wh, "stg.t")
    assert "_wm" not in history.columns
    assert high_watermark(history, "changed").first()[0] == ts("2024-01-05")


def test_a_history_from_before_the_register(spark, wh):
    old = stamp_loaded_at(rows(spark, ("1", "2024-01-05")), ts("2024-02-01")).withColumn("load_date", F.to_date("loaded_at"))
    old.write.partitionBy("load_date").parquet(wh.path("stg.t"))
    assert read_history(wh, "stg.t").count() == 1
    append_history(wh, "stg.t", stamp_loaded_at(rows(spark, ("2", "2024-01-06")).withColumn("more", F.lit("m")), ts("2024-02-02")), ["id", "changed", "more"], "changed")
    history = read_history(wh, "stg.t")
    assert sorted((r.id, r.more) for r in history.collect()) == [("1", None), ("2", "m")]
    assert high_watermark(history, "changed").first()[0] == ts("2024-01-06")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_broken_lines(spark, wh, tmp_path, fmt):
    lines = {
        "csv": ["1,2.5,a", "x,2.5,b", "3", "4,1.0,c,d", "", "5,,", '6,1,"quoted, text"', "7,1e400000,z"],
        "json": ['{"id": 1, "n": 2.5, "t": "a"}', '{"id": "x"}', "{", "[1]", "", '{"id": 5}', '{"id": 6, "n": 1, "t": "quoted, text", "u": 1}', "7"],
    }[fmt]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "lines.txt").write_text("\n".join(lines) + "\n")
    scan = scan_text(spark, fmt, str(tmp_path / "in"), "id bigint, n double, t string", str(tmp_path / "read"))
    good = sorted((r.id, r.t) for r in scan.rows.select("id", "t").collect())
    refused = sorted(r.raw_value for r in scan.refused.collect())
    assert refused == {"csv": ["3", "4,1.0,c,d", "x,2.5,b"], "json": ["7", "[1]", "{", '{"id": "x"}']}[fmt]
    assert good == {"csv": [(1, "a"), (5, None), (6, "quoted, text"), (7, "z")], "json": [(1, "a"), (5, None), (6, "quoted, text")]}[fmt]
    assert scan.rows.select("t").count() == len(good)  # whichever columns are asked for
    record_refused_lines(wh, "T", fmt, scan.refused, "r")
    assert wh.state("parse_errors").filter("source_column is null and row_key is null").count() == len(refused)


def test_text_sources_need_a_schema_and_may_be_empty(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "none.csv").write_text("")
    scan = scan_text(spark, "csv", str(tmp_path / "in"), "id bigint", str(tmp_path / "read"))
    assert scan.rows.collect() == [] and scan.refused.collect() == []
    with pytest.raises(ValueError):
        scan_text(spark, "orc", "x", "id bigint", "y")
    with pytest.raises(ValueError):
        scan_text(spark, "csv", "x", "_refused_line string", "y")
