"""All targets at once, all or nothing."""

import pytest
from pyspark.sql import functions as F

from conftest import ts
from tidemark.plans import facts as plan
from tidemark.sources.history import append_history
from tidemark.spec import FactSpec, Field


def spec(name: str, *more: Field) -> FactSpec:
    return FactSpec(f"rep.{name}", f"stg.{name}", "id", "changed", (Field("id", "id"), Field("changed", "changed", "timestamp"), *more))


def fill(spark, wh, name: str, day: int, n: int = 5) -> None:
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.lit(f"2024-01-0{day}").alias("changed"), F.lit(str(day)).alias("v"),
        F.lit(ts(f"2024-02-0{day}")).cast("timestamp_ntz").alias("loaded_at"),
    )
    append_history(wh, f"stg.{name}", rows, ["id", "changed", "v"])


def test_targets_move_together(spark, wh):
    specs = [spec(n, Field("value", "v", "numeric")) for n in "abc"]
    for n in "abc":
        fill(spark, wh, n, 1)
    done = plan.run_transforms(wh, specs, source_as_at=ts("2024-03-01"), parallel=2)
    assert [(p.target_table, p.outcome) for p in done] == [(s.target_table, "transformed") for s in specs]
    assert [wh.read_fact(s).count() for s in specs] == [5, 5, 5]
    assert wh.state("transform_watermark").count() == 3


@pytest.mark.parametrize("parallel", [1, 3])
def test_one_that_fails_keeps_all_where_they_were(spark, wh, parallel):
    good = [spec(n, Field("value", "v", "numeric")) for n in "abc"]
    for n in "abc":
        fill(spark, wh, n, 1)
    plan.run_transforms(wh, good, source_as_at=ts("2024-03-01"))
    for n in "abc":
        fill(spark, wh, n, 2, 7)
    broken = [good[0], spec("b", Field("value", "no such column")), good[2]]
    with pytest.raises(Exception, match="no such column"):
        plan.run_transforms(wh, broken, source_as_at=ts("2024-03-02"), parallel=parallel)
    assert wh.state("transform_watermark").count() == 3
    assert [wh.read_fact(s).count() for s in good] == [5, 5, 5]
    done = plan.run_transforms(wh, good, source_as_at=ts("2024-03-02"), parallel=parallel)
    assert [p.counts["insert"] for p in done] == [2, 2, 2] and [wh.read_fact(s).count() for s in good] == [7, 7, 7]
    assert not list(spark.sparkContext.getJobTags())


def test_a_target_named_twice(wh):
    with pytest.raises(ValueError, match="twice"):
        plan.run_transforms(wh, [spec("a"), spec("a")])
