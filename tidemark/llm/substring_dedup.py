"""Passages that repeat across documents, by super-k-mer partitioning.

A window is a run of words. Its minimiser is the least of its word pairs in an order that puts rare pairs first;
consecutive windows with one minimiser travel as one packed string (a super-k-mer) to the minimiser's bucket, so equal
windows meet there while a word is sent about three times instead of once per window. In the bucket the windows are
sorted and each one learns the smallest document it occurs in.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import find_package
from tidemark.llm.words import Words, mix64, slices, words_of

WINDOW = 13
#: Text per bucket; a bucket holds about three times as much and is sorted in one piece.
BUCKET_BYTES = 1 << 20
#: Packed text gathered in a task before its super-k-mers are folded and sent.
SEND_BYTES = 8 << 20
#: Cells in which word pairs are counted to find the order. Pairs of full cells come last.
CELLS = 1 << 16

_PAIR = mix64(np.array([11, 12], np.uint64)) | np.uint64(1)
_TURN = np.uint64(0x9E3779B97F4A7C15)


def _pairs(h: np.ndarray) -> np.ndarray:
    """A hash for each word and its follower."""
    return mix64(h[:-1] * _PAIR[0] + h[1:] * _PAIR[1])


def _cell(pairs: np.ndarray) -> np.ndarray:
    return (pairs & np.uint64(CELLS - 1)).astype(np.int64)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cell the word pairs in it; under -1 the bytes of text."""
    total, size = np.zeros(CELLS, np.int64), 0
    for batch in batches:
        for a, b in slices(batch["text"]):
            w = words_of(batch["text"].slice(a, b - a))
            size += len(w.data)
            if len(w.start) > 1:
                total += np.bincount(_cell(_pairs(w.hashes())), minlength=CELLS)
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *cells]), pa.array([size, *total[cells]])], ["cell", "n"])


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        v = np.minimum(v[:-step], v[step:])
        have += step
    return v


def _packed(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space behind each, and where each begins and ends there."""
    size = w.end - w.start
    begin = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 32, np.uint8)
    place = np.repeat(begin - w.start, size)
    inside = np.arange(int(size.sum())) + np.repeat(w.start - (np.cumsum(size) - size), size)
    out[inside + place] = w.data[inside]
    return out.tobytes(), begin, begin + size


def _runs(w: Words, levels: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Super-k-mers as arrays: first word, number of words, minimiser, hash of the words, text."""
    h = w.hashes()
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    pairs = _pairs(h)
    order = (levels[_cell(pairs)].astype(np.uint64) << np.uint64(58)) | (pairs >> np.uint64(6))
    at = np.flatnonzero(doc[: len(doc) - window + 1] == doc[window - 1 :])
    least = _least(order, window - 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    k = np.flatnonzero(new)
    first, words = at[k], np.diff(np.append(k, len(at))) + window - 1
    turned = np.cumprod(np.full(len(h), _TURN, np.uint64))
    back = np.cumprod(np.full(len(h), pow(int(_TURN), -1, 1 << 64), np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * turned)))
    return first, words, least[k], (total[first + words] - total[first]) * back[first] + words.astype(np.uint64), doc[first]


def _split(levels: np.ndarray, n_buckets: int, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, blob) of super-k-mers, and rows without a blob for what is decided on the spot."""
    held, size = [], 0
    for batch in batches:
        ids, tags = batch["id"].to_numpy(), batch["tag"].to_numpy()
        for a, b in slices(batch["text"]):
            w = words_of(batch["text"].slice(a, b - a))
            if len(w.start) < window:
                continue
            first, words, key, h, doc = _runs(w, levels, window)
            text, begin, end = _packed(w)
            held.append((text, size + begin[first], size + end[first + words - 1], key, h, ids[a + doc], tags[a + doc], first - w.first[doc], words))
            size += len(text)
            if size >= SEND_BYTES:
                yield _send(held, n_buckets)
                held, size = [], 0
    if held:
        yield _send(held, n_buckets)


def _send(held: list[tuple], n_buckets: int) -> pa.RecordBatch:
    """Of equal super-k-mers only those of the smallest document travel: the others are known to repeat it."""
    text = b"".join(x[0] for x in held)
    left, right, key, h, doc_id, tag, start, words = (np.concatenate(x) for x in list(zip(*held))[1:])
    left, right = left.tolist(), right.tolist()
    by = np.lexsort((doc_id, h))
    same = h[by][1:] == h[by][:-1]
    smallest: dict[bytes, int] = {}
    known = np.zeros(len(h), bool)
    for i in by[np.append(same, False) | np.insert(same, 0, False)].tolist() if len(h) else ():  # in the order of documents
        known[i] = smallest.setdefault(text[left[i] : right[i]], doc_id[i]) < doc_id[i]
    decided = np.flatnonzero(known)
    bucket = ((key & np.uint64((1 << 58) - 1)) % np.uint64(n_buckets)).astype(np.int64)
    go = np.flatnonzero(~known)
    go = go[np.argsort(bucket[go], kind="stable")]
    cuts = np.flatnonzero(np.diff(bucket[go], prepend=-1)).tolist()
    squeeze = zstandard.ZstdCompressor(level=6).compress
    blobs = []
    for x, y in zip(cuts, [*cuts[1:], len(go)]):
        part = go[x:y]
        head = [np.array([len(part)], np.int64), doc_id[part], *(z[part].astype(np.int32) for z in (tag, start, words))]
        blobs.append(squeeze(b"".join(z.tobytes() for z in head) + b" ".join([text[left[i] : right[i]] for i in part.tolist()])))
    none, m = np.zeros(len(blobs), np.int64), len(decided)
    columns = [doc_id[decided], tag[decided], start[decided], (start + words)[decided]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([bucket[go[cuts]], doc_id[decided] % n_buckets])), pa.array(blobs + [None] * m, pa.binary()),
            *(pa.array(np.concatenate([none, x.astype(np.int64)])).cast(t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))),
        ],
        ["bucket", "blob", "id", "tag", "begin", "stop"],
    )


def _repeats(blobs: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Of a bucket: documents, tags, first and last word of runs of windows that a smaller document has as well."""
    heads, texts = [], []
    for blob in blobs:
        raw = zstandard.decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        heads.append((np.frombuffer(raw, np.int64, n, 8), *np.frombuffer(raw, np.int32, 3 * n, 8 + 8 * n).reshape(3, n)))
        texts.append(raw[8 + 20 * n :])
    doc_id, tag, start, words = (np.concatenate(x) for x in zip(*heads))
    start, words = start.astype(np.int64), words.astype(np.int64)
    text = b" ".join(texts)
    w = words_of(pa.array([text], pa.large_binary()))
    h = w.hashes()
    run = np.repeat(np.arange(len(words)), words)
    at = np.flatnonzero(run[: len(run) - window + 1] == run[window - 1 :])
    sums = np.zeros(len(at), np.uint64)
    for j, scale in enumerate(np.cumprod(np.full(window, _TURN, np.uint64))):
        sums += h[at + j] * scale
    owner = doc_id[run[at]]
    by = np.lexsort((owner, sums))
    joined = sums[by][1:] == sums[by][:-1]
    new = np.concatenate(([True], ~joined))
    group = np.cumsum(new) - 1
    least = owner[by][new][group]
    repeated = np.zeros(len(at), bool)
    # where documents differ under one hash, the words themselves decide
    left, right = w.start[at], w.end[at + window - 1]
    mixed = np.zeros(int(group[-1]) + 1, bool)
    mixed[group[owner[by] != least]] = True
    smallest: dict[bytes, int] = {}
    last = -1
    inside = mixed[group]
    for g, i in zip(group[inside].tolist(), by[inside].tolist()):
        if g != last:
            last, smallest = g, {}
        repeated[i] = smallest.setdefault(text[left[i] : right[i]], owner[i]) < owner[i]
    hit = np.flatnonzero(repeated)
    if not len(hit):
        return doc_id[:0], tag[:0], start[:0], start[:0]
    runs = run[at[hit]]
    offset = start[runs] + at[hit] - (np.cumsum(words) - words)[runs]
    cut = np.flatnonzero(np.concatenate(([True], (runs[1:] != runs[:-1]) | (offset[1:] != offset[:-1] + 1))))
    final = np.append(cut[1:], len(hit)) - 1
    return doc_id[runs[cut]], tag[runs[cut]], offset[cut], offset[final] + window


def _join_buckets(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket."""
    names, held, current = ["id", "tag", "begin", "stop"], [], None

    def result():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _repeats(held, window)], names)

    for batch in batches:
        yield batch.filter(batch["blob"].is_null()).select(names)
        for bucket, blob in zip(batch["bucket"].to_pylist(), batch["blob"].to_pylist()):
            if blob is None:
                continue
            if bucket != current and held:
                yield result()
                held.clear()
            current = bucket
            held.append(blob)
    if held:
        yield result()


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch["text"]):
            part = batch.slice(a, b - a)
            w = words_of(part["text"])
            packed, begin, end = _packed(w)
            counts, removed, texts = np.diff(w.first), [], []
            for d, spans in enumerate(part["spans"].to_pylist()):
                x, y = int(w.first[d]), int(w.first[d + 1])
                edges = np.zeros(y - x + 1, np.int64)
                for s in spans or ():
                    edges[s["begin"]] += 1
                    edges[s["stop"]] -= 1
                gone = np.cumsum(edges)[:-1] > 0
                removed.append(int(gone.sum()))
                change = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).astype(np.int8))).reshape(-1, 2) + x
                texts.append(b" ".join(packed[begin[i] : end[j - 1]] for i, j in change.tolist()).decode())
            names = [n for n in part.schema.names if n not in ("spans", "kept_text")]
            yield pa.RecordBatch.from_arrays(
                [*(part[n] for n in names), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                [*names, "n_words", "n_removed", "kept_text"],
            )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: doc_id, text, n_words, n_removed, kept_text (kept words joined by one space).

    A word goes when a window that covers it also starts in a document with a smaller doc_id; windows are judged on the
    input. Repeats within one document stay, and so do equal rows of one doc_id. A null text has no words; texts of fewer
    words than a window lose nothing. A null doc_id is neither smaller nor larger than another. doc_id is an integer.

    One pass counts word pairs in a fixed number of cells, which orders the minimisers so that no frequent pair draws
    its whole neighbourhood to one bucket; the order steers the dealing only, never the result. A window in very many
    documents reaches its bucket once per few megabytes of text that hold it. Then the whole text meets its spans by doc_id.
    """
    spark = docs.sparkSession
    find_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.hash(text_col).alias("tag"), F.col(text_col).alias("text"))
    cells = rows.select("text").mapInArrow(_count_pairs, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()
    counts = np.zeros(CELLS)
    size = 0
    for cell, n in cells:
        if cell < 0:
            size = n
        else:
            counts[cell] = n
    mean = max(1.0, counts.mean())
    levels = spark.sparkContext.broadcast(np.log2(np.maximum(counts / mean, 1)).astype(np.uint8))
    n_buckets = 1 + size // BUCKET_BYTES
    parts = rows.filter("id IS NOT NULL").mapInArrow(
        lambda it: _split(levels.value, n_buckets, window, it), "bucket long, blob binary, id long, tag int, begin long, stop long"
    )
    spans = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda it: _join_buckets(window, it), "id long, tag int, begin long, stop long"
    )
    spans = spans.groupBy("id", "tag").agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    return rows.join(spans, ["id", "tag"], "left").select(F.col("id").alias("doc_id"), "text", "spans").mapInArrow(
        _remove, "doc_id long, text string, n_words long, n_removed long, kept_text string"
    )
