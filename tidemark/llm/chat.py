"""Reply trees to conversations, with built-in functions only.

Messages form trees through their parents. Self-joins that double the distance they look up give every message its
depth and the score of its path in a number of rounds that grows with the logarithm of the depth; the same jumps list
the messages of the chosen paths. A path is written as one conversation whose template can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, is_empty

#: The template. `<s>` opens a conversation; a user turn stands in [INST] [/INST], a system turn in <<SYS>> <</SYS>>, an
#: assistant turn ends in </s>; any other role is named: <<ROLE>>name<<SAYS>>text<</SAYS>>, without name for a null role.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<SAYS>>", "<</SAYS>>", "<<SAYS/>>"]
_TURN = r"(?s)\[INST\].*?\[/INST\]|<<SYS>>.*?<</SYS>>|<<(?:ROLE|SAYS/)>>.*?<</SAYS>>|.*?</s>"


def escape(text: Column) -> Column:
    """Backslashes are doubled and one goes into each control string behind its first character, so none is left."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _before(role: Column) -> Column:
    named = F.when(role.isNull(), F.lit("<<SAYS/>>")).otherwise(F.concat(F.lit("<<ROLE>>"), escape(role), F.lit("<<SAYS>>")))
    return F.when(role == "user", "[INST]").when(role == "system", "<<SYS>>").when(role == "assistant", "").otherwise(named)


def _after(role: Column) -> Column:
    return F.when(role == "user", "[/INST]").when(role == "system", "<</SYS>>").when(role == "assistant", "</s>").otherwise("<</SAYS>>")


def branches(messages: DataFrame, best: int = 1) -> tuple[DataFrame, DataFrame]:
    """Ranked branches (tree, leaf, rank, score, depth) and their messages (tree, leaf, node, depth from the root).

    `messages` has tree, node, parent and score. A branch is the path from a root to a leaf; its score is the mean of
    its messages' scores, null counting as 0. The `best` branches of a tree are kept, ties to the longer one, then to
    the smaller leaf. A message whose parent is not in the tree is a root. Messages on or below a cycle of replies have
    no root and are in no branch, nor are messages without a tree or a node. Rows that repeat a (tree, node) count once, the one with the smallest parent.
    """
    scratch = Scratch(messages.sparkSession, "branches")
    messages = messages.filter("tree IS NOT NULL AND node IS NOT NULL")
    once = messages.groupBy("tree", "node").agg(F.min_by("parent", F.coalesce("parent", F.lit(-(2**63)))).alias("parent"), F.max(F.coalesce("score", F.lit(0.0))).alias("score"))
    once = scratch.table(once)
    there = once.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    jump = once.join(there, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.col("score").cast("double").alias("sum"), F.lit(1).cast("long").alias("steps")
    )
    # level k holds the messages with an ancestor 2**k above: that ancestor, and the sum and number of what lies below it.
    # Those that have come to their root are done, so a level joins only what is deep enough for it.
    first = scratch.table(jump)
    levels, done, open_before = [first.filter("up IS NOT NULL")], first.filter("up IS NULL"), -1
    while (still := levels[-1].count()) and still != open_before:
        over = levels[-1].unionByName(done).select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("sum").alias("sum2"), F.col("steps").alias("steps2"))
        joined = levels[-1].join(over, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("sum") + F.col("sum2")).alias("sum"), (F.col("steps") + F.col("steps2")).alias("steps")
        )
        joined = scratch.table(joined)
        levels.append(joined.filter("up IS NOT NULL"))
        done, open_before = done.unionByName(joined.filter("up IS NULL")), still
    parents = levels[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = done.join(parents, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), (F.col("sum") / F.col("steps")).alias("score"), F.col("steps").alias("depth")
    )
    by = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "leaf")
    ranked = scratch.table(leaves.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= best))
    path = ranked.select("tree", "leaf", F.col("leaf").alias("node"), F.col("depth").alias("place"))
    for k in range(len(levels) - 1, -1, -1):  # every distance is one sum of powers of two, so every ancestor comes once
        above = path.join(levels[k].select("tree", "node", "up"), ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        path = scratch.table(path.unionByName(above))
    return ranked, path


def format_branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """One row per chosen branch: tree, leaf, rank, score, formatted, loss (spans of assistant texts in `formatted`).

    `messages` has tree, node, parent, score, role and text; a null text is empty. Spans are structs of start (from 0)
    and length in code points of the escaped text. One conversation is one row, as any trainer needs it; apart from that
    row nothing gathers a tree. Where rows repeat a (tree, node), the first by role and text speaks.
    """
    ranked, path = branches(messages, best)
    said = messages.groupBy("tree", "node").agg(F.min(F.struct("role", F.coalesce("text", F.lit("")).alias("text"))).alias("m"))
    turn = path.join(said, ["tree", "node"]).select("tree", "leaf", "place", F.col("m.role").alias("role"), escape(F.col("m.text")).alias("text"))
    turn = turn.withColumns({"before": _before(F.col("role")), "after": _after(F.col("role"))})
    lengths = F.char_length("before") + F.char_length("text") + F.char_length("after")
    along = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    turn = turn.withColumn("start", F.coalesce(F.sum(lengths).over(along), F.lit(0)) + len("<s>") + F.char_length("before"))
    piece = F.struct(
        "place", F.concat("before", "text", "after").alias("piece"),
        F.when(F.col("role") == "assistant", F.struct(F.col("start"), F.char_length("text").cast("long").alias("length"))).alias("span"),
    )
    whole = turn.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    whole = whole.select(
        "tree", "leaf", F.concat(F.lit("<s>"), F.array_join("pieces.piece", "")).alias("formatted"),
        F.filter("pieces.span", lambda s: s.isNotNull()).alias("loss"),
    )
    return ranked.join(whole, ["tree", "leaf"]).select("tree", "leaf", "rank", "score", "formatted", "loss")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as array of (role, text)."""
    piece = F.regexp_extract_all(F.substring(formatted, len("<s>") + 1, 2**31 - 1), F.lit(_TURN), F.lit(0))

    def between(x: Column, before: int, after: int) -> Column:
        return unescape(F.substring(x, F.lit(before + 1), F.char_length(x) - (before + after)))

    def turn(x: Column) -> Column:
        says = F.position(F.lit("<<SAYS>>"), x)
        name = unescape(F.substring(x, F.lit(9), says - 9))
        text = unescape(F.substring(x, says + 8, F.char_length(x) - says - 7 - 9))
        kind = lambda role, t: F.struct(F.lit(role).cast("string").alias("role"), t.alias("text"))
        return (
            F.when(F.startswith(x, F.lit("[INST]")), kind("user", between(x, 6, 7)))
            .when(F.startswith(x, F.lit("<<SYS>>")), kind("system", between(x, 7, 8)))
            .when(F.startswith(x, F.lit("<<SAYS/>>")), kind(None, between(x, 9, 9)))
            .when(F.startswith(x, F.lit("<<ROLE>>")), F.struct(name.alias("role"), text.alias("text")))
            .otherwise(kind("assistant", between(x, 0, 4)))
        )

    return F.transform(piece, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    part = F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(part, "")
