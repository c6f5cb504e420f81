"""Loads: plans, landing, history, reference tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.profile import profile_columns
from tidemark.plans import loads as plan
from tidemark.plans import references
from tidemark.queries.registry import at, query, table
from tidemark.sources import history as hist
from tidemark.sources.scan import stage_text, stamp_loaded_at
from tidemark.sources.store import Warehouse, shared_folder
from tidemark.spec import FactSpec, Field, TableSpec

ORDERS = TableSpec(
    "ORDERS", "stg.orders", ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"),
    "o_orderkey", "o_orderdate",
)
CUSTOMERS = TableSpec("CUSTOMER", "stg.customer", ("c_custkey", "c_name", "c_nationkey"), "c_custkey")
STAMP = at("2024-03-01T02:00:00")
CUT, CEILING, END = at("1998-01-01"), at("2000-01-01"), at("2100-01-01")
_TEXT = """CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderstatus"""


def _warehouse(spark, purpose: str) -> Warehouse:
    return Warehouse(spark, shared_folder(spark, purpose))


def _result(spark, rows):
    """Load results as a frame, one row per load, in order."""
    return spark.createDataFrame(
        [(i, r.mode, r.bounded, r.source_n, r.extracted_n, r.staged_n, r.loaded_n) for i, r in enumerate(rows, 1)],
        "step int, mode string, bounded boolean, source_n bigint, extracted_n bigint, staged_n bigint, loaded_n bigint",
    )


@query("""SELECT h AS history, m AS mode, w AS floor FROM (
          SELECT 'empty' AS h, 'unbounded' AS m, CAST(NULL AS TIMESTAMP) AS w
          UNION ALL SELECT 'filled', 'bounded', max(ts) FROM events
          UNION ALL SELECT 'no watermark', 'reference', NULL)""")
def load_plan(spark, sf):
    """The mode of three tables: an empty history, a filled one, and one without a watermark."""
    wh, columns = _warehouse(spark, "load-plan"), ("event_id", "ts")
    text = stage_text(table(spark, sf, "events").select(*columns))
    hist.append_history(wh, "stg.filled", stamp_loaded_at(text, STAMP), columns)
    specs = {h: TableSpec("EVENTS", f"stg.{h.split()[0]}", columns, "event_id", w) for h, w in (("empty", "TS"), ("filled", "TS"), ("no watermark", None))}
    plans = {h: plan.load_plan(wh, spec) for h, spec in specs.items()}
    return spark.createDataFrame([(h, p.mode, p.floor) for h, p in plans.items()], "history string, mode string, floor timestamp_ntz")


@query("""SELECT 1 AS step, 'normal' AS mode, false AS bounded, count(*) AS source_n, count(*) AS extracted_n, count(*) AS staged_n, count(*) AS loaded_n
            FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'
          UNION ALL SELECT 2, 'normal', true, count(*), count(*), count(*), count(*) FROM orders
            WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01') AND o_orderdate <= TIMESTAMP '2000-01-01'
          UNION ALL SELECT 3, 'normal', true, 0, 0, 0, 0
          UNION ALL SELECT 4, 'normal', true, count(*), count(*), count(*), count(*) FROM orders
            WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01')""")
def incremental_load(spark, sf):
    """A first load of the older orders, a bounded one up to a ceiling, one with nothing new, and the rest."""
    wh, orders = _warehouse(spark, "incremental-load"), table(spark, sf, "orders")
    steps = [
        plan.incremental_load(wh, orders.filter("o_orderdate <= timestamp_ntz'1998-01-01'"), ORDERS, CUT, loaded_at=STAMP),
        plan.incremental_load(wh, orders, ORDERS, CEILING, loaded_at=STAMP),
        plan.incremental_load(wh, orders, ORDERS, CEILING, loaded_at=STAMP),
        plan.incremental_load(wh, orders, ORDERS, END, loaded_at=STAMP),
    ]
    return _result(spark, steps)


@query(f"SELECT {_TEXT}, TIMESTAMP '2024-03-01 02:00:00' AS loaded_at FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'")
def land_overwrite(spark, sf):
    """Landing holds the last batch only: all orders first, then the older ones."""
    wh = _warehouse(spark, "landing")
    text = stamp_loaded_at(stage_text(table(spark, sf, "orders").select(*ORDERS.columns)), STAMP)
    for rows in (text, text.filter("o_orderdate <= '1998-01-01 00:00:00'")):
        hist.land_overwrite(wh, "lnd.orders", rows)
    return wh.read("lnd.orders")


@query(f"""SELECT {_TEXT}, TIMESTAMP '2024-03-01 02:00:00' AS loaded_at FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'
           UNION ALL SELECT {_TEXT}, TIMESTAMP '2024-03-02 02:00:00' FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'""")
def append_history(spark, sf):
    wh = _warehouse(spark, "history")
    text = stage_text(table(spark, sf, "orders").select(*ORDERS.columns))
    for condition, stamp in (("<=", STAMP), (">", at("2024-03-02T02:00:00"))):
        batch = stamp_loaded_at(text.filter(f"o_orderdate {condition} '1998-01-01 00:00:00'"), stamp)
        hist.append_history(wh, "stg.orders", batch, ORDERS.columns)
    return wh.read("stg.orders").drop("load_date")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                 CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, TIMESTAMP '2024-03-01 02:00:00' AS loaded_at FROM customer""")
def seed_history(spark, sf):
    """From a discovery copy with one empty column: the empty column is not carried."""
    wh = _warehouse(spark, "seed")
    copy = table(spark, sf, "customer").withColumn("unused", F.lit(""))
    profile = profile_columns(copy, "customer", profiled_at=STAMP)
    hist.seed_history(wh, copy, profile, "stg.customer", STAMP)
    return wh.read("stg.customer").drop("load_date")


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 5 <> 0) AS kept FROM customer)
          SELECT 1 AS step, 'reference-seed' AS mode, false AS bounded, n AS source_n, n AS extracted_n, n AS staged_n, n AS loaded_n FROM c
          UNION ALL SELECT 2, 'reference-ok', false, n, 0, 0, 0 FROM c
          UNION ALL SELECT 3, 'reference-drift', false, kept, kept, kept, 0 FROM c""")
def reference_pull(spark, sf):
    """Seed, check without change, and drift after rows vanished at the source."""
    wh, customer = _warehouse(spark, "reference"), table(spark, sf, "customer")
    steps = [
        plan.reference_load(wh, source, CUSTOMERS, loaded_at=STAMP)
        for source in (customer, customer, customer.filter("c_custkey % 5 <> 0"))
    ]
    return _result(spark, steps)


@query("""SELECT 1 AS step, 'normal' AS mode, false AS bounded, count(*) AS source_n, count(*) AS extracted_n,
                 CAST(0 AS BIGINT) AS staged_n, CAST(0 AS BIGINT) AS loaded_n FROM orders""")
def dry_run(spark, sf):
    wh = _warehouse(spark, "dry-run")
    return _result(spark, [plan.dry_run(wh, table(spark, sf, "orders"), ORDERS, CEILING)])


@query("SELECT 'ORDERS' AS source_table, 'stg.orders' AS target_table, max(o_orderdate) AS last_watermark FROM orders")
def set_extract_watermark(spark, sf):
    wh = _warehouse(spark, "extract-watermark")
    text = stamp_loaded_at(stage_text(table(spark, sf, "orders").select(*ORDERS.columns)), STAMP)
    hist.land_overwrite(wh, "lnd.orders", text)
    plan.set_extract_watermark(wh, ORDERS)
    return wh.current("extract_watermark").select("source_table", "target_table", "last_watermark")


@query(f"SELECT {_TEXT} FROM orders")
def reseed_history(spark, sf):
    """Load, empty the history, seed it from an older copy, load again: no order is missing."""
    wh, orders = _warehouse(spark, "reseed"), table(spark, sf, "orders").select(*ORDERS.columns)
    plan.incremental_load(wh, orders.filter("o_orderdate <= timestamp_ntz'1998-01-01'"), ORDERS, CUT, loaded_at=STAMP)
    wh.clear(ORDERS.target_table)
    copy = orders.filter("o_orderdate <= timestamp_ntz'1996-01-01'")
    hist.seed_history(wh, copy, profile_columns(copy, "orders", profiled_at=STAMP), ORDERS.target_table, at("2024-03-02"))
    plan.incremental_load(wh, orders, ORDERS, END, loaded_at=at("2024-03-03"))
    return hist.read_history(wh, ORDERS.target_table).select(*ORDERS.columns)


@query(f"""SELECT {_TEXT}, CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def growing_scope(spark, sf):
    """A column that joins the scope between two loads is NULL in the rows of the first."""
    wh, orders = _warehouse(spark, "scope"), table(spark, sf, "orders")
    grown = TableSpec("ORDERS", "stg.orders", (*ORDERS.columns, "o_orderpriority"), "o_orderkey", "o_orderdate")
    plan.incremental_load(wh, orders.filter("o_orderdate <= timestamp_ntz'1998-01-01'"), ORDERS, CUT, loaded_at=STAMP)
    plan.incremental_load(wh, orders, grown, END, loaded_at=at("2024-03-02"))
    return hist.read_history(wh, "stg.orders").select(*grown.columns)


@query(f"""SELECT {_TEXT} FROM orders WHERE o_orderdate > TIMESTAMP '1994-05-01 12:00:00' AND o_orderdate <= TIMESTAMP '1997-02-03 01:02:03'""")
def watermark_range(spark, sf):
    """Rows of a loaded history by their own modification time: both bounds reach the scan of its typed watermark."""
    wh = _warehouse(spark, "watermark-range")
    plan.incremental_load(wh, table(spark, sf, "orders"), ORDERS, END, loaded_at=STAMP)
    history = hist.read_history(wh, ORDERS.target_table)
    return hist.watermark_range(history, "o_orderdate", at("1994-05-01T12:00:00"), at("1997-02-03T01:02:03")).select(*ORDERS.columns)


ORDER_FACT = FactSpec("rep.orders", "stg.orders", "order_no", "modified", (
    Field("order_no", "o_orderkey"), Field("modified", "o_orderdate", "timestamp"), Field("price", "o_totalprice", "numeric"),
))


@query("""WITH o AS (SELECT count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '1998-01-01') AS a, count(*) AS n FROM orders),
          c AS (SELECT count(*) AS c, count(*) FILTER (WHERE c_custkey % 5 <> 0) AS k FROM customer)
          SELECT 1 AS night, 'succeeded' AS run, 'ORDERS' AS "table", 'succeeded' AS status, a AS source_n, a AS extracted_n, a AS staged_n, a AS loaded_n FROM o
          UNION ALL SELECT 1, 'succeeded', 'CUSTOMER', 'succeeded', c, c, c, c FROM c
          UNION ALL SELECT 2, 'succeeded', 'ORDERS', 'succeeded', n - a, n - a, n - a, n - a FROM o
          UNION ALL SELECT 2, 'succeeded', 'CUSTOMER', 'drift', k, k, k, 0 FROM c
          UNION ALL SELECT 3, 'failed', 'ORDERS', 'failed', NULL, NULL, NULL, NULL
          UNION ALL SELECT 3, 'failed', 'CUSTOMER', 'succeeded', c, 0, 0, 0 FROM c
          UNION ALL SELECT 3, 'failed', 'rep.orders', 'rows', NULL, NULL, NULL, (SELECT count(DISTINCT o_orderkey) FROM orders)""")
def run_load(spark, sf):
    """Three nights: a first load, more orders with a reference table that drifts, a night in which a column is gone."""
    wh, orders, customer = _warehouse(spark, "nights"), table(spark, sf, "orders"), table(spark, sf, "customer")
    nights = [
        (CUT, orders.filter("o_orderdate <= timestamp_ntz'1998-01-01'"), customer),
        (at("2100-01-01"), orders, customer.filter("c_custkey % 5 <> 0")),
        (at("2100-01-02"), orders.drop("o_orderstatus"), customer),
    ]
    for ceiling, *sources in nights:
        plan.run_load(wh, dict(zip(("ORDERS", "CUSTOMER"), sources)), [ORDERS, CUSTOMERS], ceiling, [ORDER_FACT])
    night = F.when(F.year("watermark_to") == 1998, 1).otherwise(F.dayofmonth("watermark_to") + 1).alias("night")
    runs = wh.current("load_run").select("run_id", night, F.col("status").alias("run"))
    tables = wh.current("load_table_run").join(runs, "run_id").select(
        "night", "run", F.col("source_table").alias("table"), "status", F.col("source_row_count").alias("source_n"),
        F.col("extracted_row_count").alias("extracted_n"), F.col("staged_row_count").alias("staged_n"), F.col("loaded_row_count").alias("loaded_n"),
    )
    none = F.lit(None).cast("bigint")
    fact = wh.read_fact(ORDER_FACT).agg(F.count("*").alias("loaded_n")).select(
        F.lit(3).alias("night"), F.lit("failed").alias("run"), F.lit("rep.orders").alias("table"), F.lit("rows").alias("status"),
        none.alias("source_n"), none.alias("extracted_n"), none.alias("staged_n"), "loaded_n",
    )
    return tables.unionByName(fact)


SEGMENTS = TableSpec("CUSTOMER", "stg.segment", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "c_custkey")


@query("""WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer),
          after AS (SELECT * FROM c WHERE c_custkey % 11 <> 0),
          before AS (SELECT * REPLACE (CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment)
                     FROM c WHERE c_custkey % 5 <> 0),
          new_rows AS (SELECT * FROM after EXCEPT SELECT * FROM before), old_rows AS (SELECT * FROM before EXCEPT SELECT * FROM after)
          SELECT CAST(coalesce(n.c_custkey, o.c_custkey) AS VARCHAR) AS row_key,
                 CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
                 CASE WHEN o.c_custkey IS NULL THEN 0 ELSE 1 END AS n_before, CASE WHEN n.c_custkey IS NULL THEN 0 ELSE 1 END AS n_after
          FROM new_rows n FULL JOIN old_rows o ON n.c_custkey = o.c_custkey""")
def reference_changes(spark, sf):
    """The source has lost some rows, gained others, and holds another text for a few."""
    wh, customers = _warehouse(spark, "reference-changes"), table(spark, sf, "customer").select(*SEGMENTS.columns)
    older = customers.filter("c_custkey % 5 <> 0").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "CHANGED").otherwise(F.col("c_mktsegment"))
    )
    hist.append_history(wh, SEGMENTS.target_table, stamp_loaded_at(stage_text(older), STAMP), SEGMENTS.columns)
    return references.reference_changes(wh, customers.filter("c_custkey % 11 <> 0"), SEGMENTS)
