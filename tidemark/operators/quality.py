"""Checks on loaded data: counts, duplicates, orphans, domains, casts that failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.casts import clock_text, set_flag, try_date, try_numeric, try_ts
from tidemark.functions.text import row_hash
from tidemark.sources.scan import ident
from tidemark.spec import FactSpec, LOADED_AT

CASTS = {"timestamp": try_ts, "date": try_date, "clock": clock_text, "numeric": try_numeric}


def two_counts(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """The row counts of two tables as one row, in one aggregation that reads no column."""
    sides = left.select(F.lit(True).alias("_left")).unionByName(right.select(F.lit(False).alias("_left")))
    return sides.agg(
        F.count_if(F.col("_left")).alias(left_name), F.count_if(~F.col("_left")).alias(right_name)
    )


def parity_check(left: DataFrame, right: DataFrame) -> DataFrame:
    """Whether two tables hold the same number of rows, as one result row."""
    return two_counts(left, right, "n_left", "n_right").withColumn("same", F.col("n_left") == F.col("n_right"))


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, with their number of rows.

    The child is counted per key first, so a hot key is one row when it reaches the join.
    """
    per_key = child.filter(ident(fk).isNotNull()).groupBy(ident(fk).alias(fk)).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(ident(pk).alias(fk)).distinct()
    return per_key.join(known, fk, "left_anti")


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    return orphan_keys(child, fk, parent, pk).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphans"), F.count(F.lit(1)).alias("n_orphan_keys")
    )


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose foreign key is set and has no parent. Nothing stands between the shuffles and the join,
    so that adaptive execution can split a hot key; a parent key that repeats does no harm."""
    known = parent.select(ident(pk).alias("_pk"))
    return child.filter(ident(fk).isNotNull()).join(known, ident(fk) == F.col("_pk"), "left_anti")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key combinations held by more than one row; combinations with a NULL do not conflict."""
    set_keys = df
    for k in keys:
        set_keys = set_keys.filter(ident(k).isNotNull())
    return set_keys.groupBy(*[ident(k).alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n")
    ).filter("n > 1")


def domain_violations(df: DataFrame, domains: dict[str, tuple], required=(), keys=()) -> DataFrame:
    """Rows whose value is outside its allowed set, or whose required column is NULL.

    One output row per violation: the key columns, the column and the value. A NULL passes a domain.
    """
    found = [
        F.when(
            ~ident(c).isin(*allowed),
            F.struct(F.lit(c).alias("column_name"), ident(c).cast("string").alias("value"),
                     F.lit("not allowed").alias("problem")),
        )
        for c, allowed in domains.items()
    ] + [
        F.when(
            ident(c).isNull(),
            F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("value"),
                     F.lit("missing").alias("problem")),
        )
        for c in required
    ]
    return _inline_found(df, found, keys)


def _inline_found(df: DataFrame, found: list[Column], keys) -> DataFrame:
    """A row for each non-NULL struct of each input row. Nothing is shuffled, and each finding is evaluated once:
    a filter on the findings before they are expanded would evaluate them a second time."""
    return (
        df.select(*[ident(k) for k in keys], F.explode(F.array(*found)).alias("_f"))
        .filter(F.col("_f").isNotNull()).select(*[ident(k) for k in keys], "_f.*")
    )


def refusal(field, typed: Column) -> Column:
    """What is known of a value that is set and that its guarded cast turned into NULL; NULL for any other value."""
    raw = ident(field.source)
    return F.when(
        set_flag(raw) & typed.isNull(),
        F.struct(
            F.lit(field.source).alias("source_column"), raw.alias("raw_value"),
            F.lit(f"not a {field.kind}").alias("error_type"),
        ),
    )


def parse_errors(history: DataFrame, spec: FactSpec) -> DataFrame:
    """One row per value that is set and that its guarded cast turned into NULL.

    Columns: row_key, source_column, raw_value, error_type (the type that was wanted).
    """
    found = [refusal(f, CASTS[f.kind](ident(f.source))) for f in spec.fields if f.kind in CASTS]
    keyed = history.withColumn("row_key", ident(spec.source_key))
    return _inline_found(keyed, found, ["row_key"])


def reference_diff(landed: DataFrame, history: DataFrame) -> DataFrame:
    """Distinct rows on one side only, with the side. ``loaded_at`` differs on every load and is
    left out.

    One grouping over both sides instead of two set differences: half the shuffles, and repeated
    rows are collapsed before it.
    """
    columns = [c for c in landed.columns if c != LOADED_AT]
    sides = landed.select(*[ident(c) for c in columns], F.lit(1).alias("_l"), F.lit(0).alias("_h")).unionByName(
        history.select(*[ident(c) for c in columns], F.lit(0).alias("_l"), F.lit(1).alias("_h"))
    )
    return (
        sides.groupBy(*[ident(c) for c in columns]).agg(F.max("_l").alias("_l"), F.max("_h").alias("_h"))
        .filter("_l <> _h")
        .select(F.when(F.col("_l") == 1, "landed_only").otherwise("history_only").alias("side"),
                *[ident(c) for c in columns])
    )


def content_hash(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash of the content, to catch an edit in place that a count
    cannot see. Row order and column order do not matter."""
    columns = sorted(c for c in df.columns if c != LOADED_AT)
    row = row_hash(*[ident(c) for c in columns])
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("hash_xor"),
        F.sum(row.cast("decimal(28,0)")).alias("hash_sum"),
    )


def reference_state(source_n: Column, staged_n: Column) -> Column:
    """seed when the history is empty, ok when the counts agree, otherwise drift."""
    return (
        F.when(staged_n == 0, "reference-seed")
        .when(source_n == staged_n, "reference-ok")
        .otherwise("reference-drift")
    )


def reference_check(source: DataFrame, history: DataFrame) -> DataFrame:
    """source_n, staged_n and mode, as one row."""
    counts = two_counts(source, history, "source_n", "staged_n")
    return counts.withColumn("mode", reference_state(F.col("source_n"), F.col("staged_n")))
