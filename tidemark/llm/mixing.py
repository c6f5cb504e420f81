"""Temperature mixing of sources, with built-in functions only.

A source's weight is its token share to the power of an exponent, normalised. The exponent is bisected until the
weights reach a target entropy, or until no source is repeated too often. The weights become token budgets, and a budget
is drawn as whole passes over the source followed by the start of one more: in each pass the source's blocks are permuted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.shared import Scratch

#: Tokens of a block, about. Only the block in which a budget ends is ordered document by document.
BLOCK_TOKENS = 1 << 17


@dataclass(frozen=True)
class Mix:
    exponent: float
    budgets: dict[str, int]


def weights(tokens: dict[str, int], exponent: float) -> dict[str, float]:
    total = sum(tokens.values())
    powers = {s: (n / total) ** exponent for s, n in sorted(tokens.items())}
    return {s: p / sum(powers.values()) for s, p in powers.items()}


def fit(tokens: dict[str, int], target_entropy: float, max_repeats: float, budget: int | None = None) -> Mix:
    """The largest exponent in [0, 1] whose weights reach the target entropy (nats), if no source is then repeated more
    than `max_repeats` times; else the smallest that keeps that limit. Rounded to six digits.

    The budget is in tokens. None stands for the least budget that draws every source at least once: no document is lost.
    """

    def needed(w: dict[str, float]) -> float:
        return budget if budget is not None else max(n / w[s] for s, n in tokens.items())

    def reached(a: float) -> bool:
        return -sum(x * math.log(x) for x in weights(tokens, a).values()) >= target_entropy

    def repeated(a: float) -> bool:
        w = weights(tokens, a)
        return max(w[s] * needed(w) / n for s, n in tokens.items()) > max_repeats

    def bisect(still: callable) -> float:
        """Where `still` turns from true to false between 0 and 1."""
        low, high = 0.0, 1.0
        for _ in range(40):
            middle = (low + high) / 2
            low, high = (middle, high) if still(middle) else (low, middle)
        return round(low, 6)

    exponent = 1.0 if reached(1.0) else bisect(reached)
    if repeated(exponent):
        exponent = 1.0 if repeated(1.0) else bisect(repeated)
    w = weights(tokens, exponent)
    total = needed(w)
    # a hair more than the product, so that a source that is drawn exactly once is not short of its last token
    budgets = {s: math.floor(w[s] * total + 1e-6) for s in w}
    if budget is None:  # the hair is less than a rounding step of a large product
        budgets = {s: max(tokens[s], n) for s, n in budgets.items()}
    return Mix(exponent, budgets)


def _number(*parts: Column) -> Column:
    """A number from 0 to 2**32 - 1 that the parts decide."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def draw(docs: DataFrame, tokens: Column, target_entropy: float | None = None, max_repeats: float = 4.0, budget: int | None = None,
         even_share: float = 0.95, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row per drawn document and pass: doc_id, source, n_tokens, epoch (from 0), block_place (of its block in the pass).

    A training order is epoch, block_place, then any fixed order within the block. `tokens` must be at least 1. The target
    is `target_entropy` nats or, if that is None, `even_share` of the entropy of equal weights. A null source counts as
    the source of the empty name, a null id as one of its own. A document that does not fit the rest of a budget ends it.
    Rows that repeat are drawn each on its own. An empty table gives no rows.

    Sources are few enough to be listed; documents are not: a source of any size is summed by block before anything is
    ordered, and one block per source is ordered by document.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "mixing")
    rows = scratch.table(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(source_col, F.lit("")).alias("source"), tokens.cast("long").alias("n_tokens")))
    held = {r.source: r.n for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    if not held:
        return rows.select("doc_id", "source", "n_tokens", F.lit(0).alias("epoch"), F.lit(0).alias("block_place"))
    target = even_share * math.log(len(held)) if target_entropy is None else target_entropy
    mix = fit(held, target, max_repeats, budget)
    plan = [(s, n, mix.budgets[s] // n, mix.budgets[s] % n, 1 + n // BLOCK_TOKENS) for s, n in held.items()]
    plan = spark.createDataFrame(plan, "source string, held long, passes long, rest long, n_blocks long")

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # the plan is a row per source, listed on the driver a moment ago; a shuffle by source would put a large one in one task
    rows = rows.join(F.broadcast(plan), "source").withColumn("block", F.pmod(_number(F.lit(seed), name), F.col("n_blocks")))
    blocks = rows.groupBy("source", "block", "passes", "rest").agg(F.sum("n_tokens").alias("bytes"))
    blocks = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), "passes")))
    order = Window.partitionBy("source", "epoch").orderBy(_number(F.lit(seed), F.col("epoch"), F.col("source"), F.col("block")), "block")
    blocks = blocks.withColumns({
        "block_place": F.row_number().over(order) - 1, "before": F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes"),
    })
    # room is what the pass may still take when it comes to the block
    blocks = blocks.withColumn("room", F.when(F.col("epoch") < F.col("passes"), F.col("bytes")).otherwise(F.least("bytes", F.col("rest") - F.col("before"))))
    blocks = scratch.table(blocks.filter("room > 0").select("source", "block", "epoch", "block_place", "room", "bytes"))
    drawn = rows.select("doc_id", "source", "n_tokens", "block").join(blocks, ["source", "block"])
    inside = Window.partitionBy("source", "block", "epoch").orderBy(_number(F.lit(seed), F.col("epoch"), name), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    ends = drawn.filter("room < bytes").withColumn("upto", F.sum("n_tokens").over(inside)).filter("upto <= room").drop("upto")
    return drawn.filter("room = bytes").unionByName(ends).select(
        "doc_id", "source", "n_tokens", F.col("epoch").cast("int").alias("epoch"), F.col("block_place").cast("int").alias("block_place")
    )


def count_words(text: Column) -> Column:
    """Words and one separator: the tokens a document costs where no tokenizer is named."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1
