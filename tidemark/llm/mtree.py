"""Exact top-k by inner product with an M-tree.

A vector x with an extra coordinate sqrt(M2 - |x|**2), where M2 is the largest squared norm, is a point on a sphere; for a
query with extra coordinate 0 the squared distance is |q|**2 + M2 - 2 <q, x>, so the nearest point has the highest inner
product. Spark routes the points, level by level, to the nearest of a few routing objects until a subtree has at most
`SUBTREE` points; within a subtree they are dealt to pages. A node on the way keeps its routing object, its covering
radius and the distance to its parent's routing object; a page keeps those too, beside the distances of its points to its own.
Blocks of queries descend the nodes in Spark and lose, at each, the queries that the triangle inequality rules out; only the
others meet a subtree. There the search opens pages by their least possible distance and leaves out what stored distances
rule out.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, is_empty

SUBTREE, PAGE, FANOUT = 4096, 64, 16
#: Levels by distance; what is still too large then, as a vector that repeats without end, is dealt by a hash of its id.
LEVELS = 12
QUERY_BLOCK = 256
#: Vectors with a component from here on are scored beside the tree, where scores are exact at any size.
LARGEST = 1 << 20
#: Times sqrt(M2) and the number of components: above the rounding of all distances of one comparison.
SLACK = 2.0**-49


def _points(vectors: list[bytes], m2: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Integer vectors, and the points on the sphere."""
    v = np.zeros((len(vectors), dim), np.int64)
    for row, x in zip(v, vectors):
        row[: len(x) // 4] = np.frombuffer(x, np.int32)
    return v, np.column_stack((v, np.sqrt(np.maximum(m2 - (v * v).sum(axis=1), 0)))).astype(np.float64)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T), 0))


def _integers(scale: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = [np.floor(np.array(x, np.float64) * scale).astype(np.int64) for x in batch["v"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], pa.array([x.astype(np.int32).tobytes() for x in v], pa.binary()), pa.array([int((x * x).sum()) for x in v], pa.int64()), pa.array([len(x) for x in v], pa.int32())],
            ["vec_id", "v", "norm", "dim"],
        )


def _route(m2: int, dim: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each point goes to the nearest routing object of its node; where those are all one point, its hash decides."""
    for batch in batches:
        _, points = _points(batch["v"].to_pylist(), m2, dim)
        nodes, out = np.array(batch["node"].to_pylist(), object), np.empty(len(batch), object)
        route, own = np.empty(len(batch), object), np.zeros(len(batch))
        for node in set(nodes.tolist()):
            at = np.flatnonzero(nodes == node)
            first = batch.slice(int(at[0]), 1).to_pylist()[0]
            _, routes = _points(first["routes"], m2, dim)
            if len(routes) > 1:
                child = _distances(points[at], routes).argmin(axis=1)
            else:
                child = batch["hash"].to_numpy()[at] % (1 + 2 * first["size"] // SUBTREE)
            out[at] = [f"{node}.{c}" for c in child.tolist()]
            chosen = child if len(routes) > 1 else np.zeros(len(at), np.int64)
            own[at] = np.sqrt(((points[at] - routes[chosen]) ** 2).sum(axis=1))
            route[at] = np.array(first["routes"], object)[chosen]
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], batch["v"], batch["hash"], pa.array(out.tolist(), pa.string()), pa.array(nodes.tolist(), pa.string()), pa.array(route.tolist(), pa.binary()), pa.array(own)],
            ["vec_id", "v", "hash", "node", "parent", "route", "own"],
        )


_TREE = "node string, ids binary, vectors binary, pages binary, centre binary, spread double, routes binary, apart binary, radius binary, within binary"


def _build(m2: int, dim: int, table: pa.Table) -> pa.Table:
    """A subtree as one row: points by page and, within a page, by their distance to its routing object."""
    table = table.sort_by([("hash", "ascending"), ("vec_id", "ascending")])
    v, points = _points(table["v"].to_pylist(), m2, dim)
    ids = table["vec_id"].to_numpy()
    n_pages = -(-len(points) // PAGE)
    routes = points[:: max(1, len(points) // n_pages)][:n_pages]
    page = np.concatenate([_distances(points[i : i + 1024], routes).argmin(axis=1) for i in range(0, len(points), 1024)])
    own = np.sqrt(((points - routes[page]) ** 2).sum(axis=1))
    by = np.lexsort((own, page))
    # a page of more points than it may hold is continued on further pages with the same routing object
    start = np.searchsorted(page[by], np.arange(n_pages + 1))
    cuts = np.array([x for a, b in zip(start[:-1], start[1:]) for x in range(a, b, PAGE)] + [len(by)], np.int64)
    of = page[by][cuts[:-1]]
    own = own[by]
    apart = np.sqrt(((routes[of] - routes[0]) ** 2).sum(axis=1))
    row = {
        "node": [table["node"][0].as_py()], "ids": [ids[by].astype(np.int64).tobytes()], "vectors": [v[by].astype(np.int32).tobytes()],
        "pages": [cuts.tobytes()], "centre": [routes[0].tobytes()], "spread": [float(np.sqrt(((points - routes[0]) ** 2).sum(axis=1)).max())],
        "routes": [routes[of].tobytes()], "apart": [apart.tobytes()], "radius": [own[cuts[1:] - 1].tobytes()], "within": [own.tobytes()],
    }
    return pa.table({k: pa.array(x, pa.binary() if isinstance(x[0], bytes) else None) for k, x in row.items()})


def _reach(q: np.ndarray, m2: int, score: int | None) -> float:
    """Points further away from a query than this have a lower score."""
    if score is None:
        return np.inf
    base = int((q * q).sum()) + m2  # exact, as scores are
    return np.sqrt(float(max(base - 2 * score, 0))) + SLACK * (len(q) + 8) * max(np.sqrt(m2), 1.0)


class _Subtree:
    def __init__(self, row: dict, dim: int):
        def floats(name: str) -> np.ndarray:
            return np.frombuffer(row[name], np.float64)

        self.ids, self.vectors = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], np.int32).reshape(-1, dim)
        self.pages, self.centre, self.spread = np.frombuffer(row["pages"], np.int64), floats("centre"), row["spread"]
        self.routes, self.apart, self.radius, self.within = floats("routes").reshape(-1, dim + 1), floats("apart"), floats("radius"), floats("within")

    def search(self, query: int, q: np.ndarray, k: int, least: int | None, m2: int) -> list[tuple[int, int]]:
        """The best k points (score, -id) with a score of at least `least`."""
        point = np.append(q, 0).astype(np.float64)
        limit, best = _reach(q, m2, least), []
        to_centre = float(np.sqrt(((point - self.centre) ** 2).sum()))
        if to_centre - self.spread > limit:
            return best
        # without looking at a page: the triangle over the subtree's routing object
        bound = np.maximum(np.abs(to_centre - self.apart) - self.radius, 0)
        heap = [(b, 0, i) for i, b in enumerate(bound.tolist()) if b <= limit]
        heapq.heapify(heap)
        while heap and heap[0][0] <= limit:
            b, known, i = heapq.heappop(heap)
            if not known:  # now its own distance, which may put it further back
                to_page = float(np.sqrt(((point - self.routes[i]) ** 2).sum()))
                heapq.heappush(heap, (max(b, to_page - float(self.radius[i])), to_page + 1.0, i))
                continue
            to_page = known - 1.0
            a, z = self.pages[i], self.pages[i + 1]
            a, z = a + np.searchsorted(self.within[a:z], to_page - limit), a + np.searchsorted(self.within[a:z], to_page + limit, "right")
            scores = self.vectors[a:z].astype(np.int64) @ q
            for s, x in zip(scores.tolist(), self.ids[a:z].tolist()):
                if x != query and (least is None or s >= least):
                    (heapq.heappush if len(best) < k else heapq.heappushpop)(best, (s, -x))
            if len(best) == k:
                limit = min(limit, _reach(q, m2, best[0][0]))
        return best


def _exact(scale: int, vector: list[float]) -> list[int]:
    """floor(scale * x), also where the product leaves the range of doubles."""
    return [math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale for x in vector]


def _beside(k: int, scale: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best k of a block of candidates for each of a block of queries, in integers of any size."""
    for batch in batches:
        for i in range(len(batch)):
            row, found = batch.slice(i, 1).to_pylist()[0], []
            held = [(x["vec_id"], _exact(scale, x["v"])) for x in row["candidates"]]
            for x in row["queries"]:
                q = _exact(scale, x["v"])
                scores = ((sum(a * b for a, b in zip(q, v)), -y) for y, v in held if y != x["vec_id"])
                found += [(x["vec_id"], -y, s) for s, y in heapq.nlargest(k, scores)]
            if any(not -(1 << 63) <= s < 1 << 63 for *_, s in found):
                raise OverflowError("a score among the best needs more than 64 bits")
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((),) * 3)], ["query_id", "vec_id", "score"])


def _scored_beside(queries: DataFrame, candidates: DataFrame, k: int, scale: int) -> DataFrame:
    """Blocks of queries meet blocks of candidates; one of the two sides holds huge vectors alone."""
    def blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
        n = 1 + rows.count() // size
        part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).alias(f"{name}_block")
        return rows.groupBy(part).agg(F.collect_list(F.struct("vec_id", "v")).alias(name)), n

    asked, n = blocks(queries, QUERY_BLOCK, "queries")
    held, _ = blocks(candidates, QUERY_BLOCK, "candidates")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("queries_block")
    return held.select("candidates", every).join(asked, "queries_block").select("queries", "candidates").mapInArrow(
        lambda it: _beside(k, scale, it), "query_id long, vec_id long, score long"
    )


def _search(k: int, m2: int, dim: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a subtree beside a block of queries (ids, vectors, scores to beat)."""
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            tree, found = _Subtree(row, dim), []
            q, _ = _points([x["v"] for x in row["queries"]], m2, dim)
            for x, own in zip(row["queries"], q):
                found += [(x["query_id"], -y, s) for s, y in tree.search(x["query_id"], own, k, x["least"], m2)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((),) * 3)], ["query_id", "vec_id", "score"])


_QUERIES = "queries array<struct<query_id: long, v: binary, least: long, own: string, to_node: double>>"


def _descend(m2: int, dim: int, nearest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block of queries beside the children of the node it has reached: for each child, the queries that it may concern,
    or those to which it is the nearest."""
    for batch in batches:
        for i in range(len(batch)):
            row, nodes, kept = batch.slice(i, 1).to_pylist()[0], [], []
            asked, children = row["queries"], row["children"]
            q, points = _points([x["v"] for x in asked], m2, dim)
            points[:, dim] = 0
            limit = np.array([_reach(own, m2, x["least"]) for x, own in zip(asked, q)])
            to_node = np.array([np.nan if x["to_node"] is None else x["to_node"] for x in asked])  # the root has no routing object
            centre = _points([row["route"]], m2, dim)[1][0] if row["route"] is not None else None
            routes = _points([c["route"] for c in children], m2, dim)[1]
            if nearest:
                away = np.sqrt(((points[:, None] - routes) ** 2).sum(axis=2))
                best = away.argmin(axis=1)
                for c in set(best.tolist()):
                    nodes.append(children[c]["node"])
                    kept.append([{**asked[j], "to_node": float(away[j, c])} for j in np.flatnonzero(best == c).tolist()])
                children = []
            for child, at in zip(children, routes):
                apart = np.nan if centre is None else float(np.sqrt(((centre - at) ** 2).sum()))
                near = np.flatnonzero(~(np.abs(to_node - apart) - child["radius"] > limit))
                away = np.sqrt(((points[near] - at) ** 2).sum(axis=1))
                found = [(j, d) for j, d in zip(near.tolist(), away.tolist()) if d - child["radius"] <= limit[j] and asked[j]["own"] != child["node"]]
                if found:
                    nodes.append(child["node"])
                    kept.append([{**asked[j], "to_node": d} for j, d in found])
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(kept, batch.schema.field("queries").type)], ["node", "queries"])


def _meetings(blocks: DataFrame, inner: DataFrame, scratch: Scratch, m2: int, dim: int, nearest: bool = False) -> DataFrame:
    """node, queries: the subtrees that blocks of queries meet, apart from the one where each was first; with `nearest`, that
    one: the end of the path of nearest routing objects. `inner` has a row for each node: node, parent, route, radius."""
    children = inner.groupBy("parent").agg(F.collect_list(F.struct("node", "route", "radius")).alias("children"))
    children = children.join(inner.select("node", "route"), F.col("parent") == F.col("node"), "left").select(F.col("parent").alias("node"), "route", "children")
    children, met, at = scratch.table(children), None, blocks
    while True:
        leaves = at.join(children.select("node"), "node", "left_anti")
        met = leaves if met is None else met.unionByName(leaves)
        at = scratch.table(at.join(children, "node").select("queries", "route", "children").mapInArrow(
            lambda it: _descend(m2, dim, nearest, it), f"node string, {_QUERIES}"
        ))
        if is_empty(at):
            return met


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query with all other rows.

    Components are floor(scale * x). Queries are the rows for which the column `is_query` holds. Ties go to the smaller
    vec_id; a query with fewer than k others gets them all. Vectors that are null or hold a null or a non-finite
    component take no part, nor do rows without an id; shorter vectors count as filled up with zeros. Rows with the
    query's id are its own; other rows that repeat are found once each. Extra columns are ignored.

    Vectors with a component of LARGEST or more stay out of the tree: as candidates they meet all queries, as queries
    all candidates, block by block, in exact integers. A best score that needs more than 64 bits is an error.
    Each other query first searches one subtree, along the nearest routing objects, which gives a score to beat; then blocks of queries descend the tree
    and meet the subtrees that may hold a better one.
    """
    scratch = Scratch(vectors.sparkSession, "mtree")
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)
    is_huge = F.exists("v", lambda c: F.abs(c) >= LARGEST)
    everything, huge = rows, scratch.table(rows.filter(is_huge))
    beside = None
    if not is_empty(huge):
        asked = everything.filter("query").dropDuplicates(["vec_id"])
        beside = _scored_beside(asked, huge, k, scale)
        if not is_empty(huge.filter("query")):
            beside = beside.unionByName(_scored_beside(huge.filter("query").dropDuplicates(["vec_id"]), everything.filter(~is_huge), k, scale))
        beside = scratch.table(beside)
    rows = everything.filter(~is_huge)
    queries = rows.filter("query").select("vec_id")
    points = scratch.table(rows.select("vec_id", "v").mapInArrow(lambda it: _integers(scale, it), "vec_id long, v binary, norm long, dim int"))
    m2, dim = points.agg(F.max("norm"), F.max("dim")).first()
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    if m2 is None:
        if beside is not None:
            return beside.withColumn("rank", order).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return points.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.col("norm").alias("score"))
    hashed = F.shiftrightunsigned(F.xxhash64("vec_id"), 1).alias("hash")
    level, ready, inner = scratch.table(points.select("vec_id", "v", hashed, F.lit("0").alias("node"))), None, None
    for depth in range(LEVELS + 1):
        sizes = level.groupBy("node").agg(F.count("*").alias("size"))
        small = level.join(sizes.filter(F.col("size") <= SUBTREE).select("node"), "node", "left_semi").select("vec_id", "v", "hash", "node")
        ready = small if ready is None else ready.unionByName(small)
        sizes = scratch.table(sizes.filter(F.col("size") > SUBTREE))
        if is_empty(sizes):
            break
        first = F.row_number().over(Window.partitionBy("node").orderBy("hash", "vec_id"))
        routes = level.join(sizes, "node", "left_semi").withColumn("place", first).filter(F.col("place") <= (FANOUT if depth < LEVELS else 1))
        routes = scratch.table(routes.groupBy("node").agg(F.collect_set("v").alias("routes")).join(sizes, "node"))
        level = scratch.table(level.join(routes, "node").select("vec_id", "v", "hash", "node", "routes", "size").mapInArrow(
            lambda it: _route(m2, dim, it), "vec_id long, v binary, hash long, node string, parent string, route binary, own double"
        ))
        below = level.groupBy("parent", "node").agg(F.first("route").alias("route"), F.max("own").alias("radius"))
        inner = below if inner is None else inner.unionByName(below)
    else:
        ready = ready.unionByName(level.select("vec_id", "v", "hash", "node"))  # dealt by hash just now
    ready = scratch.table(ready)
    trees = scratch.table(ready.groupBy("node").applyInArrow(lambda t: _build(m2, dim, t), _TREE))

    asked = ready.join(queries.distinct(), "vec_id", "left_semi").dropDuplicates(["vec_id"])
    asked = scratch.table(asked.select(F.col("vec_id").alias("query_id"), "v", "node", "hash"))
    query = F.struct("query_id", "v", F.lit(None).cast("long").alias("least"))
    part = F.pmod("hash", F.lit(1 + asked.count() // QUERY_BLOCK)).alias("block")

    def blocks(queries: DataFrame, least, first) -> DataFrame:
        query = F.struct("query_id", "v", least.alias("least"), first.alias("own"), F.lit(None).cast("double").alias("to_node"))
        return scratch.table(queries.groupBy(part).agg(F.collect_list(query).alias("queries")).select(F.lit("0").alias("node"), "queries"))

    if inner is not None:
        inner = scratch.table(inner)
        first = _meetings(blocks(asked, F.lit(None).cast("long"), F.lit(None).cast("string")), inner, scratch, m2, dim, nearest=True)
        first = first.select("node", F.explode("queries").alias("q")).select("q.query_id", "q.v", "node")
        asked = scratch.table(first.withColumn("hash", F.shiftrightunsigned(F.xxhash64("query_id"), 1)))
    own = asked.groupBy("node", part).agg(F.collect_list(query).alias("queries"))
    schema = "query_id long, vec_id long, score long"
    near = scratch.table(trees.join(own, "node").mapInArrow(lambda it: _search(k, m2, dim, it), schema))
    beat = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
    met = near
    if inner is not None:
        meetings = _meetings(blocks(asked.join(beat, "query_id", "left"), F.col("least"), F.col("node")), inner, scratch, m2, dim)
        met = near.unionByName(trees.join(meetings, "node").mapInArrow(lambda it: _search(k, m2, dim, it), schema))
    if beside is not None:
        met = met.unionByName(beside)
    return met.withColumn("rank", order).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
