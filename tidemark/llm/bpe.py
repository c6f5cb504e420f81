"""BPE encoding and decoding with forced boundaries.

A pair of bytes that occurs inside no token of the vocabulary can never be merged, so a word is certain to be cut
between them. Each word falls into fragments at such pairs; fragments are encoded on their own and concatenated.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.shared import find_package
from tidemark.llm.words import slices

#: Entries of each of the two generations of a process's caches; they change its speed, never its result.
CHUNKS, WORDS = 80_000, 220_000

#: Unicode's White_Space, as inside a character class. Python's str.split() also cuts at U+001C to U+001F.
_WHITE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_ONLY_PYTHON = re.compile(r"[\x1C-\x1F]")
_SPLIT = re.compile(f"[{_WHITE}]+")


def _ranges(text: str) -> list[tuple[int, int]]:
    """Ranges written as hexadecimal code points."""
    return [(int(a, 16), int(b or a, 16)) for a, _, b in (r.partition("-") for r in text.split())]


# Where the tokenizers library's Unicode tables differ from those of Python 3.13 (Unicode 15.1). Its classes
# are those of Unicode 16, its lower case is that of 17, its NFC is older than both.
#: Letters and numbers of Unicode 16 that 15.1 leaves unassigned.
_NEWER = {
    "L": _ranges(
        "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 "
        "113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"
    ),
    "N": _ranges("10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"),
}
#: Capitals assigned after 15.1, each range with its first small letter.
_CAPITALS = {
    "1C89": 0x1C8A, "A7CB": 0x0264, "A7CC": 0xA7CD, "A7CE": 0xA7CF, "A7D2": 0xA7D3, "A7D4": 0xA7D5, "A7DA": 0xA7DB, "A7DC": 0x019B,
    "10D50-10D65": 0x10D70, "16EA0-16EB8": 0x16EBB,
}
#: Marks that its NFC does not know: they neither move nor combine, and nothing moves over them.
_UNMOVED = _ranges(
    "7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 "
    "10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 "
    "16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)

_LOWER = {a + i: small + i for r, small in _CAPITALS.items() for a, b in _ranges(r) for i in range(b - a + 1)}


def _inside(ranges: Iterable[tuple[int, int]]) -> str:
    """Ranges as inside a character class."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


_FENCE = re.compile(f"([{_inside(_UNMOVED)}])")
_DIFFERS = re.compile(f"[{_inside(_UNMOVED)}{_inside((c, c) for c in _LOWER)}]")


def _nfc(text: str) -> str:
    """NFC as the library makes it, with capitals that Python does not know made small."""
    if not _DIFFERS.search(text):
        return unicodedata.normalize("NFC", text)
    return "".join(unicodedata.normalize("NFC", part) for part in _FENCE.split(text)).translate(_LOWER)


@dataclass(frozen=True)
class Vocabulary:
    """What the encoder needs of a tokenizer file. Its size is that of the file, whatever the data."""

    tokens: dict[int, str]
    ranks: dict[int, int]  # first id << 20 | second id -> rank of the merge
    merged: tuple[int, ...]  # rank -> id of the merged token
    inner: tuple[int, ...]  # id of each byte inside a word
    final: tuple[int, ...]  # id of each byte at its end
    joined: frozenset[tuple[int, int]]  # the byte pairs that occur inside a token
    special: dict[str, int]
    pattern: str


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in vocabulary files of byte-level BPE."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@cache
def _category(major: str) -> str:
    """The code points of a general category, L or N, as inside a character class."""
    newer = {c for a, b in _NEWER[major] for c in range(a, b + 1)}
    of = [unicodedata.category(chr(c))[0] == major or c in newer for c in range(sys.maxunicode + 1)]
    starts = [c for c, x in enumerate(of) if x and not (c and of[c - 1])]
    ends = [c for c, x in enumerate(of) if x and not (c < sys.maxunicode and of[c + 1])]
    return _inside(zip(starts, ends))


def read_vocabulary(path: str) -> Vocabulary:
    """From a tokenizer file: byte-level BPE with a word-end suffix; NFC, white space and lower case as normalisers.

    Letters, numbers and lower case are those of Python's Unicode tables with what the library's have beyond them.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, chars = file["model"], _byte_chars()
    kinds = [n["type"] for n in file["normalizer"]["normalizers"]]
    split, bytelevel = file["pre_tokenizer"]["pretokenizers"]
    if (model["type"], kinds, bytelevel["use_regex"], file["decoder"]) != ("BPE", ["NFC", "Replace", "Lowercase"], False, None):
        raise ValueError("this kind of tokenizer file is not supported")
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    byte = {c: b for b, c in enumerate(chars)}
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    plain = (t.removesuffix(end) for t in vocab if t not in special)
    merges = model["merges"]
    ranks = {vocab[a] << 20 | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
    return Vocabulary(
        {i: t for t, i in [*vocab.items(), *special.items()]}, ranks, tuple(vocab[a + b] for a, b in merges), tuple(vocab[c] for c in chars), tuple(vocab[c + end] for c in chars),
        frozenset((byte[a], byte[b]) for t in plain for a, b in zip(t, t[1:])), special,
        split["pattern"]["Regex"].replace(r"\s", _WHITE).replace(r"\p{L}", _category("L")).replace(r"\p{N}", _category("N")),
    )


class _Cache(dict):
    """Keeps what was used lately: the older generation goes when the newer one is full."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value


class Encoder:
    def __init__(self, v: Vocabulary):
        self.v, self.words = v, re.compile(v.pattern)
        self.special = re.compile("|".join(map(re.escape, sorted(v.special, key=len, reverse=True))) or r"(?!)")
        self.word, self.chunk = _Cache(self._word, WORDS), _Cache(self._chunk, CHUNKS)

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers, one after the other."""
        if not any(s in text for s in self.v.special):
            return self._plain(text)
        ids, at = [], 0
        for m in self.special.finditer(text):
            ids += [self._plain(text[at : m.start()]), array("i", [self.v.special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*ids, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        """No token reaches across white space, so what stands between is looked up as a whole."""
        chunks = _SPLIT.split(text) if _ONLY_PYTHON.search(text) else text.split()
        return b"".join(map(self.chunk.__getitem__, chunks))

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii():  # letter by letter: str.lower() alone would make a final sigma
            chunk = _nfc(chunk).replace("Σ", "σ")
        return b"".join(map(self.word.__getitem__, self.words.findall(chunk.lower())))

    def _word(self, word: str) -> bytes:
        raw, joined, inner, ids, begin = word.encode(), self.v.joined, self.v.inner, [], 0
        for i, pair in enumerate(zip(raw, raw[1:]), 1):
            if pair not in joined:
                ids += self._merge([inner[b] for b in raw[begin:i]])
                begin = i
        ids += self._merge([*[inner[b] for b in raw[begin:-1]], self.v.final[raw[-1]]])
        return array("i", ids).tobytes()

    def _merge(self, ids: list[int]) -> list[int]:
        """Joins the pair of the lowest rank, the leftmost of equals, until no pair can be joined."""
        if len(ids) > 200:
            return self._merge_long(ids)
        rank, merged, none = self.v.ranks.get, self.v.merged, len(self.v.merged)
        ranks = [rank(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        ranks.append(none)
        while (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i] = merged[best]
            del ids[i + 1], ranks[i]
            if i + 1 < len(ids):
                ranks[i] = rank(ids[i] << 20 | ids[i + 1], none)
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 20 | ids[i], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for fragments whose square would be felt."""
        ranks, after, before = self.v.ranks, list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(ranks[p], i, p) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (p := a << 20 | b) in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or ids[i] << 20 | ids[j] != pair:
                continue
            ids[i], ids[j], after[i] = self.v.merged[rank], -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids) and (p := ids[x] << 20 | ids[y]) in ranks:
                    heapq.heappush(heap, (ranks[p], x, p))
        return [i for i in ids if i >= 0]


_kept: list[Encoder] = []


def _encoder(v: Vocabulary) -> Encoder:
    """The encoder this process used last, with its caches, if it is for the same vocabulary."""
    if not _kept or _kept[0].v is not v:
        _kept[:] = [Encoder(v)]
    return _kept[0]


def _text(v: Vocabulary, ids: Iterable[int]) -> str:
    return " ".join(map(v.tokens.__getitem__, ids))


def _schema(docs: DataFrame, col: str, kind: str) -> str:
    """The columns of `docs` but `col`, then `col`, as a schema for Arrow tasks."""
    return ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema if f.name != col), f"`{col}` {kind}"])


def _with(batch: pa.RecordBatch, col: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != col]
    return pa.RecordBatch.from_arrays([*(batch[n] for n in names), values], [*names, col])


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """`docs` with the token ids of each whole text as array<int>, without special tokens added. With `decoded_col`, the
    ids are decoded in the same task, as `decode` does.

    The strings of special tokens inside a text become those tokens. Null and empty texts have no ids. A column that
    is already called `ids_col` is replaced; column names must differ otherwise. Nothing is shuffled.
    """
    find_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        for batch in batches:
            for a, b in slices(batch[text_col]):
                part = batch.slice(a, b - a)
                ids = [encoder.encode(t) for t in pc.fill_null(part[text_col], "").to_pylist()]
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                part = _with(part, ids_col, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
                if decoded_col is not None:
                    part = _with(part, decoded_col, pa.array([_text(held.value, memoryview(i).cast("i")) for i in ids], pa.string()))
                yield part

    schema = _schema(docs, ids_col, "array<int>")
    return docs.mapInArrow(run, schema if decoded_col is None else f"{schema}, `{decoded_col}` string")


def decode(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`docs` with the tokens of each row's ids, special ones too, joined by one space: the file names no decoder.

    Null ids decode to the empty text; an id outside the vocabulary is an error.
    """
    find_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                texts = [_text(held.value, i or ()) for i in part[ids_col].to_pylist()]
                yield _with(part, text_col, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, _schema(docs, text_col, "string"))
