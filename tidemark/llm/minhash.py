"""Near duplicates: fast similarity sketches, banding, exact verification, components.

The sketch (Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching", 2017) throws every element of a set into one of
`COORDS` bins and keeps the smallest in each; rounds with new hashes fill the bins still empty, and a second series of
rounds fills one given bin each, so after at most `2 * COORDS` rounds no coordinate is empty. Two sets agree in a
coordinate with the probability of their similarity, concentrated like independent draws.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.shared import Scratch, is_empty
from tidemark.llm.words import mix64, shingle_sets, slices

#: 32 bands of 4 coordinates: a pair at similarity 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.
COORDS, BAND = 128, 4
WIDTH = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Cells in which shingles are counted to find an order, rarest first.
CELLS = 1 << 20

_SEEDS = mix64(np.arange(1, 2 * COORDS + 1, dtype=np.uint64))
_BAND_SEEDS = mix64(np.arange(7001, 7001 + COORDS, dtype=np.uint64)) | np.uint64(1)
_TOP = np.uint64(64 - COORDS.bit_length() + 1)
_BINS = np.arange(COORDS, dtype=np.uint64)


def sketch(s: np.ndarray) -> np.ndarray:
    """The coordinates of a set of 64-bit hashes that is not empty."""
    coords = np.zeros(COORDS, np.uint64)
    empty = _BINS
    for r in range(2 * COORDS):
        u = mix64(s ^ _SEEDS[r])
        if r < COORDS:  # the top bits are the bin, the rest the value
            u.sort()
            at = np.searchsorted(u, empty << _TOP)
            at[at == len(u)] = 0
            least = u[at]
            hit = (least >> _TOP) == empty
            coords[empty[hit]] = least[hit] + _SEEDS[r]
            empty = empty[~hit]
        elif len(empty) and (empty == r - COORDS).any():
            coords[r - COORDS] = u.min() + _SEEDS[r]
            empty = empty[empty != r - COORDS]
        if not len(empty):
            break
    return coords


def band_keys(coords: np.ndarray) -> np.ndarray:
    return mix64((coords * _BAND_SEEDS).reshape(-1, BAND).sum(axis=1, dtype=np.uint64))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch["text"]):
            sizes, sets, bands = [], [], []
            for s in shingle_sets(batch["text"].slice(a, b - a), WIDTH):
                sizes.append(len(s))
                sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(band_keys(sketch(s)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["id"].slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "n", "set", "bands"],
            )


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose whole sets are similar enough. Rows come sorted by a, so a's set is made once."""
    last, held = pa.scalar(None, pa.string()), None
    for batch in batches:
        linked = []
        for a, b in slices(batch["text_b"]):
            for i, other in enumerate(shingle_sets(batch["text_b"].slice(a, b - a), WIDTH), a):
                if not batch["text_a"][i].equals(last):
                    last, held = batch["text_a"][i], next(shingle_sets(batch["text_a"].slice(i, 1), WIDTH))
                both = np.concatenate((held, other))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= PERCENT * (len(both) - common))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        for a, b in slices(batch["text"]):
            for s in shingle_sets(batch["text"].slice(a, b - a), WIDTH):
                np.add.at(total, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])


def _prefixes(levels: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of each set, as many as a partner must share one of, with their places in the order."""
    for batch in batches:
        for a, b in slices(batch["text"]):
            out = []
            for s in shingle_sets(batch["text"].slice(a, b - a), WIDTH):
                n = len(s)
                keep = s[np.lexsort((s, levels[(s & np.uint64(CELLS - 1)).astype(np.int64)]))][: n - (PERCENT * n + 99) // 100 + 1]
                out.append((keep.view(np.int64), n))
            sizes = np.array([len(k) for k, _ in out])
            row = np.repeat(np.arange(a, b), sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(row)), batch["label"].take(pa.array(row)), pa.array(np.repeat([n for _, n in out], sizes), pa.int64()),
                    pa.array(np.concatenate([k for k, _ in out])), pa.array(np.concatenate([np.arange(x) for x in sizes])),
                ],
                ["id", "label", "n", "shingle", "pos"],
            )


def _candidates(left: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of different labels among `left` (id, label, text) that may be similar enough; none is missed.

    In one order of all shingles, rarest first, two sets that reach the similarity share one of their first few, and from
    the first they share on enough must be left of both. A copy with many changes starts with shingles nobody shares.
    """
    cells = left.select("text").mapInArrow(_count_cells, "cell long, n long").groupBy("cell").agg(F.sum("n"))
    counts = np.zeros(CELLS)
    for cell, n in cells.toLocalIterator():
        counts[cell] = n
    levels = left.sparkSession.sparkContext.broadcast(np.log2(np.maximum(counts, 1)).astype(np.uint8))
    rows = scratch.table(left.mapInArrow(lambda it: _prefixes(levels.value, it), "id long, label long, n long, shingle long, pos long"))
    frequent = rows.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("shingle")
    rows = scratch.table(rows.join(frequent, "shingle"))
    whole = 100 + PERCENT
    x = rows.toDF("shingle", "a", "la", "na", "pa")
    y = rows.filter(f"pos < n - ({2 * PERCENT} * n + {whole - 1}) div {whole} + 1").toDF("shingle", "b", "lb", "nb", "pb")
    pairs = x.join(y, "shingle").filter(
        f"la <> lb AND (nb < na OR nb = na AND b < a) AND 100 * nb >= {PERCENT} * na AND {whole} * least(na - pa, nb - pb) >= {PERCENT} * (na + nb)"
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    A document's set holds the distinct runs of five words of its whole text, A-Z in lower case, as 64-bit hashes; fewer
    words are one run. Documents are linked when their sets reach the similarity, and component_id is the smallest
    doc_id that links reach. Null texts and texts without words have an empty set and stay alone. Rows that share a
    doc_id are one vertex. Rows with a null doc_id are left as they are: no component, kept. Other columns are ignored.

    Equal sets are one class from the start. Classes that share a band form a bucket. First every member of a bucket is
    compared with the bucket's first document: a bucket of n copies costs n comparisons. Where a bucket then still spans
    several components, its members go on to a second pass that compares, across components, exactly the pairs whose
    rarest shingles leave a link possible (prefix and position filter); nothing is capped and no link is lost.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = scratch.table(texts.mapInArrow(_sketches, "id long, n long, set binary, bands array<long>"))
    full = sets.filter("n > 0 AND id IS NOT NULL")
    classes = scratch.table(full.groupBy("set", "n", "bands").agg(F.min("id").alias("id")))  # a class goes by its first document

    members = classes.select("id", "n", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("last")).filter("a <> last").select("key", "a")
    members = scratch.table(members.join(buckets, "key"))
    sizes = members.filter("id = a").select("key", F.col("n").alias("na"))
    node_texts = scratch.table(texts.join(members.select("id").distinct(), "id", "left_semi"))

    def linked(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(node_texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        with_a = with_b.join(node_texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        return with_a.select("a", "b", "text_a", "text_b").mapInArrow(_links, "a long, b long")

    same_id = full.groupBy("id").agg(F.min("set").alias("set"), F.max("set").alias("other")).filter("set <> other").select("id")
    same_id = full.join(same_id, "id").join(classes.select("set", F.col("id").alias("b")), "set").select(F.col("id").alias("a"), "b")
    star = members.join(sizes, "key").filter(f"id <> a AND 100 * least(n, na) >= {PERCENT} * greatest(n, na)")
    links = same_id.unionByName(linked(star.select("a", F.col("id").alias("b")).distinct()))
    roots = scratch.table(components(links, scratch))

    labelled = members.select("key", "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
    labelled = scratch.table(labelled.select("key", "id", F.coalesce("root", "id").alias("label")))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    open_ = labelled.join(mixed, "key").select("id", "label").distinct()
    left = scratch.table(node_texts.join(open_, "id"))
    if not is_empty(left):
        links = linked(_candidates(left, scratch)).unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(links, scratch)

    own = sets.join(classes.select("set", F.col("id").alias("first")), "set", "left")
    own = own.join(roots.withColumnRenamed("node", "first"), "first", "left")
    component = F.coalesce("root", "first", "id")
    return own.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
