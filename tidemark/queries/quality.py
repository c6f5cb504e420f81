"""Checks on loaded data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as ops
from tidemark.plans.facts import checked_fact, record_parse_errors
from tidemark.queries.facts import CHARGE, INCIDENT
from tidemark.queries.registry import SQL_KIND, at, frame, frame_sql, query, sql_flag, table
from tidemark.sources.history import append_history
from tidemark.sources.store import Warehouse, shared_folder


def _parents(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus <> 'P'")


_NO_PARENT = "NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')"


@query(f"SELECT l_orderkey, count(*) AS n FROM lineitem l WHERE {_NO_PARENT} GROUP BY l_orderkey")
def orphan_keys(spark, sf):
    return ops.orphan_keys(table(spark, sf, "lineitem"), "l_orderkey", _parents(spark, sf), "o_orderkey")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE {_NO_PARENT}")
def orphan_rows(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ops.orphan_rows(items, "l_orderkey", _parents(spark, sf), "o_orderkey")


@query(f"SELECT count(*) AS n_orphans, count(DISTINCT l_orderkey) AS n_orphan_keys FROM lineitem l WHERE {_NO_PARENT}")
def orphan_count(spark, sf):
    return ops.orphan_count(table(spark, sf, "lineitem"), "l_orderkey", _parents(spark, sf), "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return ops.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT n_left, n_right, n_left = n_right AS same FROM (SELECT count(*) AS n_left FROM lineitem), (SELECT count(*) AS n_right FROM orders)")
def parity_check(spark, sf):
    return ops.parity_check(table(spark, sf, "lineitem"), table(spark, sf, "orders"))


@query("""SELECT 'landed_only' AS side, * FROM (SELECT * FROM customer EXCEPT SELECT * FROM
              (SELECT * REPLACE (CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment) FROM customer WHERE c_custkey % 5 <> 0))
          UNION ALL
          SELECT 'history_only', * FROM (SELECT * FROM
              (SELECT * REPLACE (CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment) FROM customer WHERE c_custkey % 5 <> 0)
              EXCEPT SELECT * FROM customer)""")
def reference_diff(spark, sf):
    """The history lacks some rows and holds an older text for others."""
    landed = table(spark, sf, "customer")
    history = landed.filter("c_custkey % 5 <> 0").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "CHANGED").otherwise(F.col("c_mktsegment"))
    )
    return ops.reference_diff(landed, history)


@query("""SELECT (SELECT count(*) FROM customer) AS source_n, (SELECT count(*) FROM customer WHERE c_custkey % 5 <> 0) AS staged_n,
                 'reference-drift' AS mode""")
def reference_check(spark, sf):
    landed = table(spark, sf, "customer")
    return ops.reference_check(landed, landed.filter("c_custkey % 5 <> 0"))


@query("SELECT count(*) AS n, count(*) > 0 AS same_content, false AS same_after_edit FROM customer")
def content_hash(spark, sf):
    """The same content in another order hashes alike; an edit in place does not."""
    df = table(spark, sf, "customer")
    edited = df.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "CHANGED").otherwise(F.col("c_mktsegment")))
    reordered = df.repartition(3, "c_name").select(*reversed(df.columns))
    first, second, third = (
        ops.content_hash(x).select("n", F.struct("hash_xor", "hash_sum").alias("h"), F.lit(i).alias("side"))
        for i, x in enumerate((df, reordered, edited))
    )
    h = [F.max(F.when(F.col("side") == i, F.col("h"))) for i in range(3)]
    return first.unionByName(second).unionByName(third).agg(
        F.max("n").alias("n"), (h[0] == h[1]).alias("same_content"), (h[0] == h[2]).alias("same_after_edit")
    )


@query(f"""WITH t AS (SELECT * FROM {frame_sql('table_run_log')})
           SELECT run_id, source_table, 'status' AS column_name, status AS value, 'not allowed' AS problem FROM t
           WHERE status NOT IN ('running', 'succeeded', 'failed', 'drift')
           UNION ALL SELECT run_id, source_table, 'watermark_from', NULL, 'missing' FROM t WHERE watermark_from IS NULL""")
def domain_violations(spark, sf):
    return ops.domain_violations(
        frame(spark, sf, "table_run_log"), {"status": ("running", "succeeded", "failed", "drift")},
        ["watermark_from"], ["run_id", "source_table"],
    )


def _parse_errors_sql(spec, source: str) -> str:
    quoted = lambda c: '"' + c + '"'
    return " UNION ALL ".join(
        f"""SELECT {quoted(spec.source_key)} AS row_key, '{f.source}' AS source_column, {quoted(f.source)} AS raw_value,
            'not a {f.kind}' AS error_type FROM {frame_sql(source)}
            WHERE {sql_flag(quoted(f.source))} AND ({SQL_KIND[f.kind](quoted(f.source))}) IS NULL"""
        for f in spec.fields if f.kind in ops.CASTS
    )


@query(_parse_errors_sql(INCIDENT, "incident_history"))
def parse_errors(spark, sf):
    return ops.parse_errors(frame(spark, sf, "incident_history"), INCIDENT)


@query(_parse_errors_sql(CHARGE, "charge_history"))
def parse_errors_charge(spark, sf):
    return ops.parse_errors(frame(spark, sf, "charge_history"), CHARGE)


_RANGE = "loaded_at > TIMESTAMP '2024-01-01 00:10:00' AND loaded_at <= TIMESTAMP '2024-01-01 12:00:00'"


@query(f"""SELECT 'run-1' AS run_id, 'stg.incident' AS source_table, e.*, TIMESTAMP '2024-03-01' AS logged_at FROM (
           {_parse_errors_sql(INCIDENT, "incident_history").replace("WHERE", f"WHERE {_RANGE} AND")}) e""", name="record_parse_errors")
def recorded_errors(spark, sf):
    """What the rows of one range of load times leave in the table of parse errors."""
    wh = Warehouse(spark, shared_folder(spark, "parse-errors"))
    append_history(wh, INCIDENT.source_table, frame(spark, sf, "incident_history"), INCIDENT.source_columns)
    record_parse_errors(wh, INCIDENT, "run-1", at("2024-01-01T00:10:00"), at("2024-01-01T12:00:00"), at("2024-03-01"))
    return wh.state("parse_errors")


def _checked_sql(spec, source: str) -> str:
    quoted = lambda c: '"' + c + '"'
    fields = ", ".join(f"{SQL_KIND[f.kind](quoted(f.source))} AS {quoted(f.target)}" for f in spec.fields)
    refused = " + ".join(
        f"CASE WHEN {sql_flag(quoted(f.source))} AND ({SQL_KIND[f.kind](quoted(f.source))}) IS NULL THEN 1 ELSE 0 END"
        for f in spec.fields if f.kind in ops.CASTS
    )
    first = " ".join(
        f"WHEN {sql_flag(quoted(f.source))} AND ({SQL_KIND[f.kind](quoted(f.source))}) IS NULL THEN '{f.source}: ' || {quoted(f.source)} || ' is not a {f.kind}'"
        for f in spec.fields if f.kind in ops.CASTS
    )
    return f"SELECT {fields}, loaded_at, {refused} AS n_refused, CASE {first} END AS first_refused FROM {frame_sql(source)}"


@query(_checked_sql(CHARGE, "charge_history"))
def checked_charge(spark, sf):
    """The typed rows with what their casts refused, in one projection."""
    first = F.try_element_at(F.col("refused"), F.lit(1))
    shown = F.concat(first["source_column"], F.lit(": "), first["raw_value"], F.lit(" is "), first["error_type"])
    return checked_fact(frame(spark, sf, "charge_history"), CHARGE).withColumns(
        {"n_refused": F.size("refused"), "first_refused": shown}
    ).drop("refused")
