import random
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm.chat import CONTROL, branches, escape, format_branches, loss_text, read_turns, unescape

SCHEMA = "tree long, node long, parent long, score double, role string, text string, leaf string, place int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows, best):
    """tree -> the chosen paths, best first."""
    nodes = defaultdict(dict)
    for tree, node, parent, score, *_ in rows:
        nodes[tree][node] = (parent, score or 0.0)
    out = {}
    for tree, known in nodes.items():
        parents = {p for p, _ in known.values()}
        paths = []
        for leaf in known:
            path, at = [], leaf
            while at in known and at not in path:
                path.append(at)
                at = known[at][0]
            if at not in known and leaf not in parents:
                paths.append((-sum(known[n][1] for n in path) / len(path), -len(path), leaf, path[::-1]))
        if paths:
            out[tree] = [p[-1] for p in sorted(paths)[:best]]
    return out


def random_trees(seed):
    rng = random.Random(seed)
    rows = []
    for tree in range(12):
        for node in range(rng.randrange(1, 60)):
            parent = None if node == 0 else rng.choice([node - 1, rng.randrange(node), 999])
            rows.append((tree, node, parent, rng.choice([None, 0.25, 0.5, 1.0]), rng.choice(["user", "assistant", "system"]), f"t{node}"))
    rows += [(50, i, i - 1 if i else None, 1.0, "user", f"deep {i}") for i in range(150)]
    rows += [(60, 1, 2, 1.0, "user", "a"), (60, 2, 1, 1.0, "user", "b"), (60, 3, 2, 1.0, "user", "below a cycle")]
    return rows


def test_best_branches_equal_brute_force(spark):
    rows = random_trees(1)
    for best in (1, 3):
        ranked, path = branches(frame(spark, rows), best)
        rank = {(r.tree, r.leaf): r["rank"] for r in ranked.collect()}
        got = defaultdict(dict)
        for r in path.orderBy("place").collect():
            got[r.tree].setdefault(rank[r.tree, r.leaf], []).append(r.node)
        assert {t: [p[k] for k in sorted(p)] for t, p in got.items()} == brute(rows, best)


def test_texts_come_back_whatever_they_hold(spark):
    rng = random.Random(2)
    parts = [*CONTROL, "\\", "\\\\", "<", "[", "é", "\n", " ", "$1", "x"]
    roles = ["user", "assistant", "system", "tool", "", "<<SAYS>>", "a\\", None]
    rows = [(t, n, n - 1 if n else None, None, rng.choice(roles), "".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for t in range(40) for n in range(5)]
    done = format_branches(frame(spark, rows)).select("tree", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("lost"), "formatted")
    got = {r.tree: r for r in done.collect()}
    for t in range(40):
        said = [(r[4], r[5]) for r in rows if r[0] == t]
        assert [(x.role, x.text) for x in got[t].turns] == said
        assert got[t].lost == "".join(x for role, x in said if role == "assistant")
    df = spark.createDataFrame([(r[5],) for r in rows], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("back")).collect():
        assert r.back == r.t and not any(c in r.e for c in CONTROL)


def test_edges(spark):
    assert format_branches(frame(spark, [])).collect() == []
    rows = [(1, 1, None, None, "user", None), (1, 1, None, None, "user", None), (1, None, 1, 1.0, "user", "no node"), (None, 1, None, 1.0, "user", "no tree"), (2, 5, 5, 1.0, "user", "its own parent")]
    got = format_branches(frame(spark, rows)).select("tree", "rank", read_turns(F.col("formatted")).alias("turns")).collect()
    assert [(r.tree, r["rank"], [(t.role, t.text) for t in r.turns]) for r in got] == [(1, 1, [("user", "")])]
    long = "é[INST]" * 200_000
    got = format_branches(frame(spark, [(1, 1, None, 0.0, "assistant", long)])).select(read_turns(F.col("formatted")).alias("turns")).first()
    assert got.turns[0].text == long


def test_messages_without_conv_id_are_a_conversation(spark, tmp_path):
    from tidemark.llm.queries import QUERIES

    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "bc"), (0, 0, "user", "d"), (0, 1, "assistant", "e"), (7, 0, "user", "f")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in QUERIES["op2_chat_formatting"](spark, str(tmp_path)).collect()}
    assert got == {None: (2, 2), 0: (2, 1), 7: (1, 0), -1: (2, 21)}
