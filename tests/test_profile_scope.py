from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import ts
from tidemark.operators import profile as p, scope as s

T1, T2 = ts("2024-05-01"), ts("2024-05-02")
SCHEMA = ("id string, name string, blank string, empty string, const string, one string, mod_ts string, "
          "created_ts string, digits string, loaded_at timestamp_ntz")
ROWS = [
    ("1", "a", "  ", "", "c", "only", "2024-01-01 10:00:00", "2024-01-01 10:00", "123\n", T1),
    ("2", "b", " ", None, "c", None, "2024-01-02T10:00", "2024-01-02 10:00", "123", T1),
    ("3", "", "  ", "", None, "", "2024-01-03 10:00:00 tail", None, "-1.5", T1),
]


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def latest(spark, wide):
    older = p.profile_columns(wide.limit(1), "t", sampled=True, profiled_at=T1)
    newer = p.profile_columns(wide, "t", profiled_at=T2)
    other = p.profile_columns(wide.select("id"), "u", profiled_at=T1)
    return p.latest_profile(older.unionByName(newer).unionByName(other)).cache()


def by_name(df):
    return {r.column_name: r for r in df.collect()}


@pytest.mark.parametrize("approximate", [False, True])
def test_profile(wide, approximate):
    rows = by_name(p.profile_columns(wide, "t", approximate_distinct=approximate))
    assert "loaded_at" not in rows and len(rows) == 9
    assert (rows["name"].populated, rows["name"].pct_filled, rows["name"].distinct_values) == (2, Decimal("66.7"), 2)
    assert rows["blank"].populated == 3 and rows["blank"].distinct_values == 2
    assert (rows["empty"].populated, rows["empty"].min_value, rows["empty"].distinct_values) == (0, None, 0)
    assert rows["mod_ts"].looks_timestamp == 3 and rows["created_ts"].looks_timestamp == 2
    assert rows["digits"].looks_numeric == 2
    assert (rows["digits"].min_value, rows["digits"].max_value) == ("-1.5", "123\n")
    assert {r.total_rows for r in rows.values()} == {3}


def test_percent_rounds_half_up(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 5, "x").alias("a"), F.when(F.col("id") < 15, "x").alias("b"))
    rows = by_name(p.profile_columns(df, "t"))
    assert (rows["a"].pct_filled, rows["b"].pct_filled) == (Decimal("0.3"), Decimal("0.8"))


def test_empty_input_has_no_profile(wide):
    assert p.profile_columns(wide.limit(0), "t").count() == 0


def test_light_profile_includes_loaded_at(wide):
    rows = by_name(p.profile_light(wide))
    assert rows["loaded_at"].populated == 3 and rows["loaded_at"].distinct_values == 1


def test_latest_is_per_table(latest):
    assert {(r.source_table, r.profiled_at) for r in latest.collect()} == {("t", T2), ("u", T1)}


def test_views(latest):
    t = latest.filter("source_table = 't'")
    assert set(by_name(p.empty_columns(t))) == {"empty"}
    assert {n: r.the_only_value for n, r in by_name(p.constant_columns(t)).items()} == {"const": "c"}
    assert {n: r.kind for n, r in by_name(p.watermark_candidates(t)).items()} == {
        "mod_ts": "unclassified", "created_ts": "creation (not usable)"
    }
    summary = p.profile_summary(t).first()
    assert (summary.n_columns, summary.empty_columns, summary.constant_columns, summary.constant_multi, summary.n_rows) == (9, 1, 2, 1, 3)


def test_candidate_names(spark):
    df = spark.createDataFrame([(c, c) for c in ("LastModified", "credit_ts", "CREATED", "amended_creation", "seen")], "column_name string, source_table string")
    full = df.withColumns({c: F.lit(1) for c in ("populated", "looks_timestamp")}).withColumns({c: F.lit("x") for c in ("min_value", "max_value")})
    assert {n: r.kind for n, r in by_name(p.watermark_candidates(full)).items()} == {
        "LastModified": "modification", "credit_ts": "modification", "CREATED": "creation (not usable)",
        "amended_creation": "modification", "seen": "unclassified",
    }


def test_survival(wide):
    rows = by_name(p.cast_survival(wide))
    assert (rows["mod_ts"].as_timestamp, rows["mod_ts"].populated) == (2, 3)
    assert (rows["digits"].as_numeric, rows["id"].as_numeric) == (2, 3)


def profile_rows(spark, rows):
    return spark.createDataFrame(
        [(t, c, 10, pop, dist, look, sampled, T1) for t, c, pop, dist, look, sampled in rows],
        "source_table string, column_name string, total_rows long, populated long, distinct_values long, "
        "looks_timestamp long, sampled boolean, profiled_at timestamp_ntz",
    )


def test_key_and_watermark(spark):
    latest = profile_rows(spark, [
        ("T", "a_id", 10, 10, 0, False), ("T", "__pkey_b", 10, 10, 0, False), ("T", "__pkey_part", 9, 9, 0, False),
        ("T", "z_updated", 5, 5, 5, False), ("T", "edited", 10, 10, 10, False), ("T", "gone", 0, 0, 0, False),
        ("U", "x", 10, 3, 0, False), ("V", "e", 0, 0, 0, False),
    ])
    assert {r.source_table: r.key_column for r in s.key_candidate(latest).collect()} == {"T": "__pkey_b"}
    assert {r.source_table: r.watermark_column for r in s.watermark_column(latest).collect()} == {"T": "edited"}
    config = {r.source_table: r for r in s.table_config(latest).collect()}
    assert set(config) == {"T", "U"}
    assert config["T"].columns == ["__pkey_b", "__pkey_part", "a_id", "edited", "z_updated"]
    assert (config["T"].target_table, config["T"].staging_table) == ("stg.t", "lnd.t")
    assert (config["U"].key_column, config["U"].watermark_column) == (s.NO_KEY, s.NO_WATERMARK)
    assert {r.source_table: r.column_list for r in s.column_list(latest).collect()} == {
        "T": '"__pkey_b", "__pkey_part", "a_id", "edited", "z_updated"', "U": '"x"', "V": None
    }
    assert '"columns":["x"]' in s.config_json(s.table_config(latest)).filter("source_table = 'U'").first().config


def test_stage_schema_refuses(spark):
    rows = profile_rows(spark, [("T", "b", 1, 1, 0, True), ("T", "a", 1, 1, 0, False), ("T", "c", 0, 0, 0, False), ("E", "x", 0, 0, 0, False)])
    with pytest.raises(ValueError, match="no profile"):
        s.stage_schema(rows, "nothing")
    with pytest.raises(ValueError, match="row-limited"):
        s.stage_schema(rows, "T")
    with pytest.raises(ValueError, match="empty"):
        s.stage_schema(rows, "E")
    assert s.stage_schema(rows, "T", allow_sampled=True).simpleString() == "struct<a:string,b:string,loaded_at:timestamp_ntz>"


def test_scope_drift(spark):
    names = lambda *xs: spark.createDataFrame([(x,) for x in xs], "column_name string")
    drift = s.scope_drift(names("a", "b", "loaded_at"), names("a", "c"), names("a", "d", "loaded_at"))
    assert {tuple(r) for r in drift.collect()} == {
        ("stg vs profile", "c", "populated at source, missing from stg"),
        ("stg vs profile", "b", "in stg, not populated at source"),
        ("stg vs lnd", "b", "in stg, missing from lnd - regenerate lnd"),
        ("stg vs lnd", "d", "in lnd, not in stg"),
    }
    assert s.scope_drift(names("a", "loaded_at"), names("a"), names("a", "loaded_at")).isEmpty()
