import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ts
from tidemark.operators.profile import profile_columns
from tidemark.operators.windows import batch_ceiling, batch_window, high_watermark
from tidemark.sources import (
    append_history, land_overwrite, normalise_columns, read_source, scan_bounded, scan_columns, scan_sample,
    seed_history, source_count, stage_text, staged_columns, stamp_loaded_at, trim_temporal,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_columns_in_list_order_and_missing(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "Id int, `Booking Charge` string, n double")
    assert scan_columns(df, ["n", "booking charge"]).columns == ["n", "booking charge"]
    with pytest.raises(ValueError, match="gone"):
        scan_columns(df, ["gone"])


def test_names_fold_and_collide(spark):
    assert normalise_columns(spark.createDataFrame([(1, 2)], "A int, `arrest_#` int")).columns == ["a", "arrest_#"]
    with pytest.raises(ValueError, match="collide"):
        normalise_columns(spark.createDataFrame([(1, 2)], "Aa int, b int").toDF("Aa", "aA"))


def test_sample_is_marked(spark):
    out = scan_sample(spark.range(100), 7)
    assert out.count() == 7 and out.filter("sampled").count() == 7


def test_bounds_are_open_below_and_closed_above(spark):
    df = spark.createDataFrame([(ts(f"2024-01-0{d}"),) for d in range(1, 6)] + [(None,)], "at timestamp_ntz")
    days = lambda x: sorted(r[0].day for r in x.collect())
    assert days(scan_bounded(df, "at", ts("2024-01-02"), ts("2024-01-04"))) == [3, 4]
    assert scan_bounded(df, "at", None, ts("2024-01-04")).count() == 6
    assert source_count(df, "at", ts("2024-01-02"), ts("2024-01-04")).first()[0] == 2
    assert source_count(df, "at", None, ts("2024-01-04")).first()[0] == 6


def test_bounds_and_columns_reach_the_scan(spark, wh):
    spark.range(10).select(
        F.expr("timestamp_ntz'2024-01-01'").alias("at"), F.col("id").alias("a"), F.col("id").alias("b")
    ).write.parquet(wh.path("lnd.x"))
    df = scan_columns(scan_bounded(wh.read("lnd.x"), "at", ts("2024-01-01"), ts("2024-01-02")), ["a"])
    plan = plan_of(df)
    assert "GreaterThan(at" in plan and "LessThanOrEqual(at" in plan
    assert "ReadSchema: struct<at:timestamp_ntz,a:bigint>" in plan


def test_text_watermark_is_compared_as_time(spark):
    df = spark.createDataFrame([("2024-1-9",), ("2024-01-10 00:00:00",), ("junk",), (None,)], "at string")
    assert high_watermark(df, "at").first()[0] == ts("2024-01-10")
    assert scan_bounded(df, "at", ts("2024-01-08"), ts("2024-01-09")).count() == 1
    assert high_watermark(df.limit(0), "at").first()[0] is None


def test_stage_text(spark):
    df = spark.createDataFrame(
        [(1, 12345678.0, True, dt.date(2024, 1, 2), ts("2024-01-02T03:04:05"), None)],
        "i int, d double, b boolean, day date, at timestamp_ntz, missing string",
    )
    assert tuple(stage_text(df).first()) == ("1", "12345678.0", "True", "2024-01-02", "2024-01-02 03:04:05", None)
    assert trim_temporal(df).first()["day"] == "2024-01-02"
    with pytest.raises(TypeError):
        stage_text(df.select(F.array("i").alias("a")))


def test_text_formats_need_a_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        read_source(spark, "csv", str(tmp_path))
    assert read_source(spark, "csv", str(tmp_path), "a string, b string", header=True).first() == ("1", "2")


def test_landing_is_replaced_and_history_grows(spark, wh):
    for day, n in (("2024-01-01", 5), ("2024-01-02", 3)):
        batch = stamp_loaded_at(stage_text(spark.range(n)), ts(day))
        assert land_overwrite(wh, "lnd.t", batch) == n
        append_history(wh, "stg.t", wh.read("lnd.t"), ["id"])
    history = wh.read("stg.t")
    assert wh.read("lnd.t").count() == 3 and history.count() == 8
    assert staged_columns(history) == ["id"]
    assert batch_ceiling(history, ts("2024-01-01")).first()[0] == ts("2024-01-02")
    window = batch_window(history, ts("2024-01-01"), ts("2024-01-02"))
    assert window.count() == 3
    assert "load_date" in plan_of(window).split("PartitionFilters: [")[1].split("]")[0]


def test_seed_carries_populated_columns_and_refuses(spark, wh):
    copy = spark.createDataFrame([("1", "", None), ("2", "", "x")], "id string, empty string, v string")
    profile = profile_columns(copy, "t")
    assert seed_history(wh, copy, profile, "stg.t", ts("2024-01-01")) == 2
    assert staged_columns(wh.read("stg.t")) == ["id", "v"]
    with pytest.raises(ValueError, match="already holds rows"):
        seed_history(wh, copy, profile, "stg.t", ts("2024-01-01"))
    with pytest.raises(ValueError, match="row-limited"):
        seed_history(wh, copy, profile_columns(copy, "t", sampled=True), "stg.u", ts("2024-01-01"))
    with pytest.raises(ValueError, match="no profile"):
        seed_history(wh, copy, profile.limit(0), "stg.u", ts("2024-01-01"))
    with pytest.raises(ValueError, match="empty"):
        seed_history(wh, copy, profile_columns(copy.select("empty"), "t"), "stg.u", ts("2024-01-01"))


def test_sampled_rows_are_rows_of_events(spark):
    from tidemark.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    got = QUERIES["scan_sample_rows"](spark, sf)
    assert got.columns == [*events.columns, "sampled"] and got.count() == min(events.count(), 100) and got.filter("sampled").count() == got.count()
    assert got.drop("sampled").exceptAll(events).count() == 0
