"""Alignment of two tokenizers: which tokens of one cover the bytes of which tokens of the other."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

#: Text whose fragments are told apart and tokenized together. A longer text is a slice of its own, whole.
SLICE_BYTES = 4 << 20
#: What a text counts besides its bytes, so that a slice of short or empty texts has an end.
TEXT_BYTES = 32
#: Bytes, pairs and texts in one row of a slice at most. Rows of megabytes fill the heap with objects that span its regions.
PART_BYTES, PART_PAIRS, PART_TEXTS = 128 << 10, 4 << 10, 1 << 10
#: Row groups of the written slices: so much is held for each writer and reader.
GROUP_BYTES = 8 << 20
#: Fragments that are handed to the libraries at once.
BATCH = 5_000
#: Fragments that are encoded as one text, and the characters of the longest of these.
JOIN, JOIN_CHARS = 32, 64
#: Identifiers of the second tokenizer take this many bits of a pair.
_B_BITS = 32

#: A single space between two of these: both tokenizers cut before the space.
_CUT = re.compile(r"(?<=[!-~À-ÿ]) (?=[!-~À-ÿ])")

#: What stands before a token within its side of a group, the first of a fragment's, of a side and of a group.
_SIGNS = ("", ",", "|", ";")

_loaded: dict[bytes, tuple] = {}


@dataclass(frozen=True)
class Pair:
    """The contents of the two vocabulary files: a byte-level tokenizer's JSON and a sentencepiece model."""

    byte_level: str
    pieces: bytes = field(repr=False)

    @staticmethod
    def read(byte_level_path: str, pieces_path: str) -> Pair:
        with open(byte_level_path, encoding="utf-8") as a, open(pieces_path, "rb") as b:
            return Pair(a.read(), b.read())

    @cached_property
    def _key(self) -> bytes:
        return hashlib.sha256(self.byte_level.encode() + self.pieces).digest()

    def load(self) -> tuple:
        """The tokenizers, the bytes of each of their tokens and whether texts may be cut; made once a process."""
        return self._all()[:5]

    def tables(self) -> tuple:
        """Each id behind each of _SIGNS, and the lengths of the tokens' bytes."""
        return self._all()[5:]

    def _all(self) -> tuple:
        key = self._key
        if key not in _loaded:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from sentencepiece import SentencePieceProcessor
            from tokenizers import Tokenizer

            a, b = Tokenizer.from_str(self.byte_level), SentencePieceProcessor(model_proto=self.pieces)
            a.encode_special_tokens = True
            a.no_padding()
            a.no_truncation()
            byte_of = {c: v for v, c in byte_letters().items()}
            bytes_a = [b""] * a.get_vocab_size()
            for token, i in a.get_vocab().items():
                bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
            names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
            bytes_b = [bytes([int(s[3:5], 16)]) if b.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)]
            # a piece with a space after another character could reach over a cut
            cuts = not any("▁" in s.lstrip("▁") for s in names)
            digits = [str(i) for i in range(max(len(bytes_a), len(bytes_b)))]
            signed = np.array([[sign + d for d in digits] for sign in _SIGNS], object)
            lengths = tuple(np.fromiter(map(len, x), np.int64, len(x)) for x in (bytes_a, bytes_b))
            _loaded[key] = a, b, bytes_a, bytes_b, cuts, signed, lengths
        return _loaded[key]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is a visible Latin-1
    character, otherwise the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [v for v in range(256) if v not in set(shown)]
    return {**{v: chr(v) for v in shown}, **{v: chr(256 + i) for i, v in enumerate(hidden)}}


@dataclass
class Aligned:
    """What `align` found for fragments; of fragment f the links are those from `link_first[f]` to `link_first[f + 1]`."""

    good: np.ndarray
    sizes: np.ndarray  # fragment; tokens of A, tokens of B, groups, links
    groups: list[str]
    link_first: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray


def _flat(lists: list, width: int, n: int) -> np.ndarray:
    items = chain.from_iterable(lists)
    return np.fromiter(chain.from_iterable(items) if width == 2 else items, np.int64, n * width).reshape(n, width)


def _ends(ids: np.ndarray, length: np.ndarray, coarse: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Where each token ends. `coarse` is right where it is `sure`; within a character only the tokens' own bytes tell."""
    refined = np.cumsum(length[ids])
    if (refined[sure] != coarse[sure]).any():
        raise ValueError("spans and decoded bytes disagree")
    return np.where(sure, coarse, refined)


def _joined(ids: list[list[int]], token_bytes: list[bytes], length: np.ndarray, data: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each fragment's tokens are the fragment's."""
    flat, n = list(chain.from_iterable(ids)), np.fromiter(map(len, ids), np.int64, len(ids))
    if b"".join([token_bytes[i] for i in flat]) == b"".join(data):
        ends = np.concatenate(([0], np.cumsum(length[np.array(flat, np.int64)])))[np.cumsum(n)]
        return ends == np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
    return np.fromiter((b"".join([token_bytes[i] for i in x]) == d for x, d in zip(ids, data)), bool, len(data))


def align(fragments: list[str], pair: Pair) -> Aligned:
    """The tokens, groups and links of fragments, each behind a space; those where the joined bytes of one
    tokenizer are not the fragment's are not good and have none.

    The character offsets of `tokenizers` and the byte spans of sentencepiece's proto are coarse cuts: tokens of one
    character share its span, and of a character written as byte tokens only the last has one. There the tokens'
    decoded bytes tell where each ends. Every place where a token of either side ends closes a link; every place where
    both end, a group.

    Short fragments between visible Latin-1 characters are encoded several at once, with the space that both tokenizers
    cut before. Where one of them is not good each is encoded alone.
    """
    cuts = pair.load()[4]
    parts = [_align(fragments[i : i + BATCH], pair, JOIN if cuts else 1) for i in range(0, len(fragments), BATCH)]
    if not parts:
        none = np.zeros(0, np.int64)
        return Aligned(none.astype(bool), none.reshape(0, 4), [], np.zeros(1, np.int64), none, none)
    sizes = np.concatenate([p.sizes for p in parts])
    return Aligned(
        np.concatenate([p.good for p in parts]), sizes, list(chain.from_iterable(p.groups for p in parts)),
        np.concatenate(([0], np.cumsum(sizes[:, 3]))), np.concatenate([p.links_a for p in parts]), np.concatenate([p.links_b for p in parts]),
    )


def _visible(c: str) -> bool:
    return "!" <= c <= "~" or "À" <= c <= "ÿ"


def _runs(fragments: list[str], join: int) -> list[int]:
    """How many fragments in turn are encoded as one text."""
    runs, room = [], 0
    for f in fragments:
        fits = join > 1 and 0 < len(f) <= JOIN_CHARS and _visible(f[0]) and _visible(f[-1])
        if fits and room:
            runs[-1] += 1
            room -= 1
        else:
            runs.append(1)
            room = join - 1 if fits else 0
    return runs


def _encode(texts: list[str], pair: Pair) -> tuple[list, ...]:
    """The bytes of texts that begin with a space, the ids and spans of both tokenizers, and whether joined bytes agree."""
    tok_a, tok_b, bytes_a, bytes_b, _ = pair.load()
    _, lengths = pair.tables()
    data = [t.encode() for t in texts]
    encoded = tok_a.encode_batch(texts, add_special_tokens=False)
    ids_a, spans_a = [e.ids for e in encoded], [e.offsets for e in encoded]
    # the spans of the immutable proto, under the name that the library gives them now
    encoded = tok_b.encode([d[1:] for d in data], return_type="offset_mapping", return_bytes=True, num_threads=1)
    ids_b, spans_b = [e["ids"] for e in encoded], [e["offsets"] for e in encoded]
    good = _joined(ids_a, bytes_a, lengths[0], data) & _joined(ids_b, bytes_b, lengths[1], data)
    return data, ids_a, spans_a, ids_b, spans_b, good.tolist()


def _align(fragments: list[str], pair: Pair, join: int) -> Aligned:
    signed, lengths = pair.tables()
    runs = _runs(fragments, join)
    to = np.cumsum(runs).tolist()
    found = _encode([" " + " ".join(fragments[i - n : i]) for i, n in zip(to, runs)], pair)
    apart = [k for k, (n, fine) in enumerate(zip(runs, found[-1])) if n > 1 and not fine]
    if apart:
        alone = _encode([" " + f for k in apart for f in fragments[to[k] - runs[k] : to[k]]], pair)
        order, at = list(range(len(runs))), len(runs)
        for k in apart:
            order[k] = range(at, at + runs[k])
            at += runs[k]
        flat = [k for o in order for k in (o if isinstance(o, range) else (o,))]
        runs = [(runs + [1] * (at - len(runs)))[k] for k in flat]
        found = tuple([(x + y)[k] for k in flat] for x, y in zip(found, alone))
    data, ids_a, spans_a, ids_b, spans_b, fine = found
    good = np.repeat(fine, runs)
    kept_runs = [k for k, x in enumerate(fine) if x]
    if len(kept_runs) < len(fine):
        ids_a, spans_a, ids_b, spans_b, data = ([x[i] for i in kept_runs] for x in (ids_a, spans_a, ids_b, spans_b, data))
    kept = np.flatnonzero(good).tolist()
    n_a, n_b, n_bytes = (np.fromiter(map(len, x), np.int64, len(kept_runs)) for x in (ids_a, ids_b, data))
    base = np.cumsum(n_bytes) - n_bytes
    a, b = _flat(ids_a, 1, n_a.sum())[:, 0], _flat(ids_b, 1, n_b.sum())[:, 0]

    begins = np.flatnonzero((np.frombuffer(b"".join(data), np.uint8) & 0xC0) != 0x80)  # of characters, then the end
    begins = np.append(begins, n_bytes.sum())
    span = _flat(spans_a, 2, len(a)) + np.repeat(np.searchsorted(begins, base), n_a)[:, None]
    last = np.zeros(len(a) + 1, bool)
    last[np.cumsum(n_a)] = True
    end_a = _ends(a, lengths[0], begins[span[:, 1]], last[1:] | (np.append(span[1:, 0], 0) >= span[:, 1]))
    span = _flat(spans_b, 2, len(b)) + np.repeat(base + 1, n_b)[:, None]  # after the space before the text
    last = np.zeros(len(b) + 1, bool)
    last[np.cumsum(n_b)] = True
    first = np.append(True, last[1:-1]) if len(b) else last[:0]
    sure = (last[1:] | (np.append(span[1:, 0], 0) >= span[:, 1])) & ((span[:, 1] > span[:, 0]) | first)
    end_b = _ends(b, lengths[1], span[:, 1], sure)

    both = np.union1d(end_a, end_b)
    ia, ib = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
    cut = both[(end_a[ia] == both) & (end_b[ib] == both)]
    ends = np.cumsum(np.fromiter((len(fragments[i].encode()) + 1 for i in kept), np.int64, len(kept)))
    if len(np.setdiff1d(ends, cut, assume_unique=True)):  # a token reaches over a cut
        if join == 1:
            raise ValueError("tokens reach over the end of a text")
        return _align(fragments, pair, 1)
    n_a, n_b, n_links, n_groups = (np.diff(np.searchsorted(x, ends, "right"), prepend=0) for x in (end_a, end_b, both, cut))

    group = np.concatenate((np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)))
    side = np.repeat((0, 1), (len(a), len(b)))
    order = np.argsort(2 * group + side, kind="stable")
    fresh = np.diff((2 * group + side)[order], prepend=-1) > 0
    starts = np.zeros(len(cut) + 1, bool)
    starts[np.cumsum(n_groups) - n_groups] = True  # the first groups of fragments
    sign = np.where(fresh, np.where(side[order] == 1, 2, np.where(starts[group[order]], 0, 3)), 1)
    text = signed[sign, np.concatenate((a, b))[order]].tolist()
    to = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
    groups, sizes = [""] * len(fragments), np.zeros((len(fragments), 4), np.int64)
    for i, x, y in zip(kept, to, to[1:]):
        groups[i] = "".join(text[x:y])
    sizes[kept] = np.stack((n_a, n_b, n_groups, n_links), 1)
    return Aligned(good, sizes, groups, np.concatenate(([0], np.cumsum(sizes[:, 3]))), a[ia], b[ib])


_SLICE = "slice string, part int, ids array<{id}>, sha array<string>, data binary, pair array<long>, n array<long>"
#: The arrays in a slice's data, one behind the other after their bytes and lengths.
_ARRAYS = 5


def _pack(arrays: list[np.ndarray]) -> bytes:
    packed = [np.ascontiguousarray(x, "<i4" if x.max(initial=0) < 1 << 31 else "<i8").tobytes() for x in arrays]
    return b"".join([np.array([*map(len, packed), *map(len, arrays)], "<i8").tobytes(), *packed])


def _unpack(data: bytes) -> list[np.ndarray]:
    head = np.frombuffer(data, "<i8", 2 * _ARRAYS).tolist()
    at, found = 16 * _ARRAYS, []
    for size, n in zip(head, head[_ARRAYS:]):
        found.append(np.frombuffer(data, "<i4" if size == 4 * n else "<i8", n, at).astype(np.int64))
        at += size
    return found


def _between(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The sums of the values from each edge to the next."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[edges])


def _slice(ids: pa.Array, texts: pa.ChunkedArray, pair: Pair, schema: pa.Schema) -> pa.RecordBatch:
    """A slice as numbered rows of bounded size."""
    cuts = pair.load()[4]
    known: defaultdict[str, int] = defaultdict()
    known.default_factory = known.__len__  # an unknown fragment gets the next number
    rows = []
    for t in (x.as_py() for x in texts):
        found = (_CUT.split(t) if cuts else [t]) if t else []
        rows.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
    fragments = list(known)
    known.clear()
    done = align(fragments, pair)
    good, sizes, strings = done.good, done.sizes, done.groups
    rows = [r if good[r].all() else r[:0] for r in rows]
    sha = [hashlib.sha256(";".join([strings[i] for i in r.tolist()]).encode()).hexdigest() if len(r) else "" for r in rows]
    first = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
    fragment = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    totals = np.stack([_between(x[fragment], first) for x in sizes.T], 1)
    often = np.bincount(fragment, minlength=len(good))
    key = (done.links_a << _B_BITS) | done.links_b
    of = np.repeat(np.arange(len(good)), sizes[:, 3])
    used = often[of] > 0  # fragments of texts without tokens alone count for nothing
    pairs, where = np.unique(key, return_inverse=True)
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, where[used], often[of[used]])
    data = _pack([totals.ravel(), first, fragment, done.link_first, where])
    parts = max(-(-len(x) // size) for x, size in ((data, PART_BYTES), (pairs, PART_PAIRS), (ids, PART_TEXTS)))

    def dealt(x, size: int) -> list:
        return [x[i * size : (i + 1) * size] for i in range(parts)]

    values = [
        [uuid.uuid4().hex] * parts, range(parts), dealt(ids.to_pylist(), PART_TEXTS), dealt(sha, PART_TEXTS), dealt(data, PART_BYTES),
        dealt(pairs, PART_PAIRS), dealt(n, PART_PAIRS),
    ]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)


def _cut_rows(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """The rows of (id, text) batches in turn, as many as a slice holds at a time; a longer text is alone."""
    held, size = [], 0
    for batch in batches:
        begin = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
            if size and size + n + TEXT_BYTES > limit:
                yield pa.Table.from_batches([*held, batch.slice(begin, i - begin)])
                held, size, begin = [], 0, i
            size += n + TEXT_BYTES
        held.append(batch.slice(begin))
    if size:
        yield pa.Table.from_batches(held)


def _count(slice_table: pa.Table, counts: pa.Table, schema: pa.Schema) -> pa.Table:
    """The rows of one slice, given (place, count, best) of each of its pairs."""
    parts = slice_table.sort_by("part")
    ids, sha = (list(chain.from_iterable(parts.column(c).to_pylist())) for c in ("ids", "sha"))
    totals, first, fragment, link_first, link_pair = _unpack(b"".join(parts.column("data").to_pylist()))
    place, of_doc = counts.column("place").to_numpy(), []
    for column in ("best", "count"):
        of_pair = np.zeros(len(place), np.int64)
        of_pair[place] = counts.column(column).to_numpy()
        of_doc.append(_between(_between(of_pair[link_pair], link_first)[fragment], first))
    columns = [ids, *totals.reshape(-1, 4).T, *of_doc, sha]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def align_tokens(docs: DataFrame, pair: Pair, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row for each row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is the byte-level tokenizer over space and text, B the sentencepiece model over the text, to which it adds the
    space. Links are the pairs of an A and a B token that share a byte; the count of a pair of ids is how many links of
    the whole table hold it. n_best are the links whose count is the highest of their B id (ties included), count_sum
    adds the counts of all links. groups_sha256 hashes `a1,a2|b1;a3|b2,b3`. Null and empty texts, and those whose joined
    token bytes are not space and text (a text with U+2581, say), have zeros and an empty groups_sha256 and count for
    nothing. Repeated rows count again; an empty table gives no rows; other columns are left out.

    Before a single space between two visible Latin-1 characters both tokenizers cut (the model's vocabulary is asked;
    otherwise texts stay whole), so a slice of texts is a sequence of few distinct fragments, each aligned once. A slice
    sends one row for each of its pairs to be counted and gets one row back, so a pair that is everywhere is one row a
    slice; what its texts are made of is kept in a written table meanwhile, in rows of some 300 KB at most.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    slice_type = _parse_datatype_string(_SLICE.format(id=kind))
    slice_schema = to_arrow_schema(slice_type)
    result = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    result_schema = to_arrow_schema(_parse_datatype_string(result))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _cut_rows(batches, slice_bytes):
            yield _slice(table.column(0).combine_chunks(), table.column(1), pair, slice_schema)

    # without a look at the size after each of the first rows a writer would hold a hundred of them
    groups = {"parquet.block.size": GROUP_BYTES, "parquet.block.size.row.check.min": 8, "parquet.page.size.row.check.min": 8}
    made = scratch.table(docs.mapInArrow(cut, slice_type), **groups)
    pairs = made.select("slice", "part", F.posexplode(F.arrays_zip("pair", "n")).alias("place", "z"))
    pairs = pairs.select("slice", (F.col("part") * PART_PAIRS + F.col("place")).alias("place"), F.col("z.pair").alias("pair"), F.col("z.n").alias("n"))
    b = F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    # of one B id there are at most as many pairs as A has tokens
    counts = scratch.table(counts.select("pair", "count", (F.col("count") == F.max("count").over(Window.partitionBy(b))).cast("long").alias("best")))
    back = pairs.join(counts, "pair").select("slice", "place", "count", "best")

    def count(rows: pa.Table, counted: pa.Table) -> pa.Table:
        return _count(rows, counted, result_schema) if rows.num_rows else pa.table([pa.array([], f.type) for f in result_schema], schema=result_schema)

    done = made.drop("pair", "n").withColumnRenamed("slice", "own").groupBy("own").cogroup(back.groupBy("slice")).applyInArrow(count, result)
    return done.withColumnRenamed("id", id_col)
