"""Spelling variants: words at one edit of each other, found by suffix ranks over the delimited vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

#: Words that one index holds, about. A half that more words share is dealt over several indexes.
INDEX_WORDS = 1 << 17

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Intervals up to this length are read symbol by symbol; for longer ones each symbol is asked for.
_NARROW = 128


def observed_words(docs: DataFrame, every: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word) for each maximal run of letters up to U+00FF, A-Z lower-cased. Where `every` divides the CRC-32 of
    `<id>:<run>`, one letter of the run is left out, so a run of one letter becomes an empty word. Null texts have no
    runs; a null id counts as empty."""
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit("([A-Za-z\\u00C0-\\u00FF]+)"))).alias("run"))
    runs = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")))
    runs = runs.select("run", h.alias("h"), (h % F.char_length("run")).cast("int").alias("at"))
    short = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    return runs.select(F.when(F.col("h") % every == 0, short).otherwise(F.col("run")).alias("word"))


class HalfIndex:
    """An FM-index of distinct words, read from their last symbol to their first.

    The words are laid out in sorted order, each ended by a delimiter. Suffixes are ordered up to their delimiter and
    then by place; the last word is laid out first, so the suffix that begins with the delimiter before word j has
    rank j. An interval of ranks stands for all suffixes that begin with what was read so far, and reading one more
    symbol to the left is two binary searches. The index of the reversed words reads from first to last.
    """

    def __init__(self, words: list[bytes]):
        laid = words[-1:] + words[:-1]
        text = np.frombuffer(b"\0".join(laid) + b"\0", np.uint8)
        length = np.fromiter(map(len, laid), np.int64, len(laid)) + 1
        self.size, self.count = len(text), len(words)
        left = np.repeat(np.cumsum(length) - 1, length) - np.arange(self.size)  # symbols before the delimiter
        padded, key = np.concatenate((text, np.zeros(8, np.uint8))), np.zeros(self.size, np.uint64)
        for j in range(8):
            key = (key << np.uint64(8)) | np.where(j <= left, padded[j : j + self.size], 0).astype(np.uint64)
        order, rank = self._rank(key)
        width = 8
        while width < int(length.max()):
            at = np.minimum(np.arange(self.size) + width, self.size - 1)
            key = rank * (self.size + 2) + np.where(width <= left, rank[at] + 1, 0)
            order, rank = self._rank(key)
            width *= 2
        before = text[order - 1].astype(np.int64)
        rows = np.argsort(before, kind="stable")
        self.before = before
        self.symbols = np.unique(before)[1:]  # all but the delimiter
        self.steps = before[rows] * self.size + rows

    @staticmethod
    def _rank(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        new = np.zeros(len(key), np.int64)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(new)
        return order, rank

    def read(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = symbol * self.size
        return np.searchsorted(self.steps, at + low), np.searchsorted(self.steps, at + high)

    def continued(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, symbol, low, high) for each symbol by which an interval can be read on."""
        wide = high - low > _NARROW
        narrow = np.flatnonzero(~wide)
        n = (high - low)[narrow]
        of = np.repeat(narrow, n)
        rows = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + low[of]
        pair = np.unique(of * 256 + self.before[rows])
        wide = np.flatnonzero(wide)
        pair = np.concatenate((pair, (wide[:, None] * 256 + self.symbols).ravel()))
        of, symbol = pair >> 8, pair & 255
        of, symbol = of[symbol > 0], symbol[symbol > 0]
        new_low, new_high = self.read(symbol, low[of], high[of])
        real = new_high > new_low
        order = np.argsort(of[real], kind="stable")
        return tuple(x[real][order] for x in (of, symbol, new_low, new_high))

    def near(self, asked: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of `asked`, word) where the word is the row with one symbol replaced or left out and both share
        the last `half` symbols. `asked` holds words of one length, a word a row, the last symbol first."""
        n, m = asked.shape
        low, high = np.zeros(n, np.int64), np.full(n, self.count, np.int64)
        row = np.arange(n)
        for i in range(half):
            low, high = self.read(asked[row, i], low, high)
        none = np.zeros(0, np.int64)
        erred = (none, none, none)  # row and interval of the readings that had their error
        for i in range(half, m):
            alive = high > low
            row, low, high = row[alive], low[alive], high[alive]
            symbol = asked[row, i]
            # replaced: read any other symbol. Rows in one interval ask once.
            key, which = np.unique(low * (self.size + 1) + high, return_inverse=True)
            of, other, to_low, to_high = self.continued(key // (self.size + 1), key % (self.size + 1))
            first = np.searchsorted(of, np.arange(len(key) + 1))
            k = (first[1:] - first[:-1])[which]
            mine = np.repeat(np.arange(len(row)), k)
            child = np.arange(len(mine)) - np.repeat(np.cumsum(k) - k, k) + first[which[mine]]
            replaced = other[child] != symbol[mine]
            mine, child = mine[replaced], child[replaced]
            # left out: stay. Of a run of one symbol only the last is left out, so a word is found once.
            skip = np.flatnonzero(symbol != asked[row, i + 1]) if i + 1 < m else np.arange(len(row))
            at, e_low, e_high = erred
            e_low, e_high = self.read(asked[at, i], e_low, e_high)
            real = e_high > e_low
            erred = (
                np.concatenate((at[real], row[mine], row[skip])),
                np.concatenate((e_low[real], to_low[child], low[skip])),
                np.concatenate((e_high[real], to_high[child], high[skip])),
            )
            low, high = self.read(symbol, low, high)
        at, e_low, e_high = erred
        e_low, e_high = self.read(np.zeros(len(at), np.int64), e_low, e_high)
        real = e_high > e_low
        return at[real], e_low[real]


def _near_in(group: list[tuple[bytes, int, bool, bool]], side: int, longest: int) -> Iterator[tuple[bytes, int, int, bytes]]:
    """(word, number of near words, largest n of them, the first such word) within one index."""
    members = sorted(g for g in group if g[3])
    asks = [g for g in group if g[2]]
    if not members or not asks:
        return
    half = longest // 2
    index = HalfIndex([g[0] for g in members])
    asked = np.frombuffer(b"".join(g[0] for g in asks), np.uint8).reshape(len(asks), longest)[:, ::-1].astype(np.int64)
    at, found = index.near(asked, half)
    if side == 0 and len(at):  # the other half tells whether the index of reversed words finds the pair as well
        ids: dict[bytes, int] = {}
        start = [np.array([ids.setdefault(g[0][:half], len(ids)) for g in side_], np.int64) for side_ in (asks, members)]
        once = start[0][at] != start[1][found]
        at, found = at[once], found[once]
    if not len(at):
        return
    way = -1 if side else 1
    words = sorted({(g[0][::way], g[1]) for g in group})  # by code points
    place = {w: i for i, (w, _) in enumerate(words)}
    of_ask = np.array([place[g[0][::way]] for g in asks], np.int64)[at]
    of_found = np.array([place[g[0][::way]] for g in members], np.int64)[found]
    shorter = np.fromiter((len(g[0]) < longest for g in members), bool, len(members))[found]
    a, b = np.concatenate((of_ask, of_found[shorter])), np.concatenate((of_found, of_ask[shorter]))
    count = np.fromiter((n for _, n in words), np.int64, len(words))
    order = np.lexsort((b, -count[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    for i, j in zip(first.tolist(), np.append(first[1:], len(a)).tolist()):
        yield words[a[i]][0], j - i, int(count[b[i]]), words[b[i]][0]


_NEAR = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _search(table: pa.Table) -> pa.Table:
    groups: dict[tuple, list] = {}
    names = ("side", "longest", "block", "latin", "n", "ask", "member")
    for side, longest, block, latin, n, ask, member in zip(*(table.column(c).to_pylist() for c in names)):
        groups.setdefault((side, longest, block), []).append((latin, n, ask, member))
    rows = [r for (side, longest, _), g in groups.items() for r in _near_in(g, side, longest)]
    word, near, best_n, best = zip(*rows) if rows else ((), (), (), ())
    return pa.table([[w.decode("latin-1") for w in word], list(near), list(best_n), [w.decode("latin-1") for w in best]], schema=_NEAR)


def near_words(words: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """(word, near, best_n, best) for each word with near words, from distinct (word, n): how many there are, the largest
    n among them and the first such word in code-point order. Near is one letter inserted, deleted or replaced.

    Two near words, the longer of M letters, share their first or their last M // 2. So each word goes to four
    places: for M its length or one more, by its first half and by its last. A place's words are indexed together,
    and those of M letters ask it: the shared half exactly, then with one error across the other half. Places are
    dealt to indexes by hash; a half that more than `index_words` words share is dealt over several indexes, and its
    askers go to each. A pair is found once: the index of last halves leaves out pairs that share the first half too.
    """
    length = F.char_length("word")
    at = F.explode(F.array(*(F.struct(F.lit(side).alias("side"), (length + more).alias("longest")) for side in (0, 1) for more in (0, 1))))
    rows = words.select("word", "n", at.alias("at")).select("word", "n", "at.*")
    half = F.expr("CASE side WHEN 0 THEN right(word, longest div 2) ELSE left(word, longest div 2) END")
    rows = rows.withColumn("half", half)
    crowded = rows.groupBy("side", "longest", "half").count().filter(F.col("count") > index_words)
    crowded = crowded.select("side", "longest", "half", F.ceil(F.col("count") / index_words).cast("int").alias("blocks"))
    rows = rows.join(crowded, ["side", "longest", "half"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own, ask = F.pmod(F.xxhash64("word", F.lit("block")), F.col("blocks")).cast("int"), length == F.col("longest")
    blocks = F.when(ask & (F.col("blocks") > 1), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    rows = rows.select("*", own.alias("own"), ask.alias("ask"), F.explode(blocks).alias("block"))
    n_buckets = max(1, 4 * words.count() // index_words)
    rows = rows.select(
        "side", "longest", "block", "n", "ask", (F.col("own") == F.col("block")).alias("member"),
        F.encode(F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")), "ISO-8859-1").alias("latin"),
        F.pmod(F.xxhash64("side", "longest", "half", "block"), F.lit(n_buckets)).alias("bucket"),
    )
    found = rows.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(_search, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("near"), best).select("word", "near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def follow(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) from (word, form): the last word that is reached by going from form to form. Each round doubles the
    reach, so the rounds grow with the logarithm of the longest way."""
    reach = scratch.table(forms.select("word", F.col("form").alias("root")))
    while True:
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not reach.join(on, "root", "left_semi").take(1):
            return reach
        reach = scratch.table(reach.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))


def group_variants(words: DataFrame, scratch: Scratch, ratio: int = 2, index_words: int = INDEX_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for distinct words of letters up to U+00FF with their counts `n`.

    A word's form is its near word of largest n (the first in code-point order among equals), if that n is at least
    `ratio` (two or more) times its own, else null; root is the end of the way along forms, the word itself without
    one. Words without near words have `n_near` 0. An empty table gives no rows. Columns beside word and n are left out.
    """
    if ratio < 2:
        raise ValueError("with a ratio below 2 forms could go round in a circle")
    words = words.select("word", "n")
    found = words.join(near_words(words, index_words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = scratch.table(found.select(
        "word", "n", F.coalesce("near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ))
    roots = follow(found.filter("form IS NOT NULL"), scratch)
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, min_chars: int = 5, min_count: int = 3, index_words: int = INDEX_WORDS) -> DataFrame:
    """`group_variants` of the words of whole texts that have `min_chars` letters and occur `min_count` times.

    Counts cover all documents: repeated rows count again, null and empty texts have no words, a word of any length
    takes part. Occurrences are summed within each task before they are shuffled, so a frequent word is one row per task.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    words = observed_words(docs).filter(F.char_length("word") >= min_chars)
    words = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    return group_variants(scratch.table(words), scratch, index_words=index_words)
