"""Personal data in texts: four kinds by fixed rules, and what a trained tagger finds beside them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import find_package
from tidemark.llm.tagger import BLOCK, PAD, Tagger, classes_of

KINDS = ("email", "ip", "card", "phone")
#: Documents whose texts are learned from: the first by a hash of the id, half of them among those with a digit or an @.
SAMPLE = 400
#: Characters of such a text that are used: as many from any place.
SAMPLE_CHARS = 4_000
#: Characters of a window, and how far the next one begins.
WINDOW, STRIDE = 128, 64
#: Training windows and steps.
EXAMPLES, STEPS = 3_000, 200
#: A span is added where its labels have this probability on average.
SURE = 0.9
#: Windows' worth of places that are decoded at once.
BATCH = 512
#: Characters of texts that are handled together, or of one longer text.
PIECE = 1 << 18
#: Places on either side of a span that its probability is judged with.
CONTEXT = 64

Span = tuple[int, int, int]  # start, kind, end

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d // 10 + d % 10 for d in twice)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans that the four rules give, in time that grows with the text alone.

    An email is looked for from its @, an address from its chain of numbers: the leftmost match begins where the run
    before the @ begins, or where the last match ended, and of a chain each four numbers in turn are a match.
    """
    spans: list[Span] = []
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            spans.append((start, 0, m.end()))
            done = m.end()
    for m in _NUMBERS.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                spans.append((at, 1, at + length))
            at += length + 1
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


# Written forms the rules do not know, and numbers that are nobody's. A pattern's 0 becomes a digit, its x a letter.

_FORMS = {
    0: ("xxxx.xx(at)xxxxxx.xxx", "xxxxx [at] xxxxxxx.xxx", "xxxx00@xxxxxx", "xxxxx.xxxxx @ xxxxxxx.xx", "xxxx(at)xxxxx.xx.xx", "xxxxx00[at]xxxxxx.xxx"),
    1: ("000.000.0.00:0000", "00 . 000 . 00 . 0", "00[.]000[.]00[.]000", "000[.]0[.]00[.]00", "000-00-0-000 (ip)"),
    2: ("0000.0000.0000.0000", "0000_0000_0000_0000", "0000/0000/0000/0000", "0000  0000  0000  0000"),
    3: ("(000) 000-0000", "000-000-0000", "000.000.0000", "0000 000000", "00 00 00 00 00", "tel 000 0000", "(00) 0000 0000", "000 000 0000"),
}
_NOBODYS = (
    "0000-00-00", "00:00", "00:00:00", "0.00", "0000", "00", "0", "00,000", "v0.0.0", "$00.00", "00%", "0000-0000", "#000000", "No. 000", "00/00/0000", "x0x0xx00x0x000xx", "0000 xxxx",
    "00000000", "x=00", "000000000000", '"00x0xx0x00xx000x0x00"', "xxx00xx=x00x0xx0", "000 xx", "(0000)", "[00]", "00.", "0x", "@xxxx", "xx @xxxxx", "p. 000", "00th",
)


def _written(pattern: str, r: np.random.Generator) -> str:
    out = [str(r.integers(10)) if c == "0" else chr(97 + r.integers(26)) if c == "x" else c for c in pattern]
    return "".join(out)


def _examples(texts: list[str], n: int, r: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows: labels are 0, and 1 + 2 * kind at the start and one more within a span of that kind.

    A third shows the texts as they are with the rules' spans, the rest has one or two written forms, rule-like ones
    among them, or nobody's numbers put in at any place.
    """
    found = {0: ["xxx.00@xxxx.xxx", "xxxxx@xxxx.xx"], 1: ["00.000.00.000", "000.00.0.000"], 2: ["0000000000000000", "0000-0000-0000-0000"], 3: ["+0 (000) 000-0000", "+00 00 0000 0000"]}
    parts = [(t, base_spans(t)) for t in texts if t]
    busy = [(t, s) for t, s in parts if s]
    xs, ys = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    for k in range(n):
        t, spans = (busy if busy and k % 3 == 0 else parts)[r.integers(len(busy if busy and k % 3 == 0 else parts))]
        if k % 3 == 0 and spans:
            start, _, end = spans[r.integers(len(spans))]
            at = max(0, int(r.integers(start - WINDOW + 16, max(start - WINDOW + 17, end - 16))))
        else:
            at = int(r.integers(0, max(1, len(t) - WINDOW)))
        x = t[at : at + WINDOW]
        marks = [(s - at, kind, e - at) for s, kind, e in spans if s < at + WINDOW and e > at]
        for _ in range(0 if k % 3 == 0 else int(r.integers(1, 3))):
            kind = int(r.integers(-2, 4))
            pool = _NOBODYS if kind < 0 else (*_FORMS[kind], *found[kind], *found[kind])
            put = _written(pool[r.integers(len(pool))], r)
            free = [i for i, c in enumerate(x[:-1]) if c in " \n" and not any(s <= i + 1 < e for s, _, e in marks)]
            if not free:
                continue
            i = free[r.integers(len(free))] + 1
            x = x[:i] + put + " " + x[i:]
            marks = [(s + (len(put) + 1) * (s >= i), kd, e + (len(put) + 1) * (s >= i)) for s, kd, e in marks]
            if kind >= 0:
                length = len(put.replace(" (ip)", "")) if not put.startswith("tel ") else len(put)
                marks.append((i + 4 * put.startswith("tel "), kind, i + length))
        x = x[:WINDOW]
        xs[k, : len(x)] = classes_of(x)
        for s, kind, e in marks:
            s, e = max(s, 0), min(e, WINDOW)
            if s < e:
                ys[k, s:e] = 2 + 2 * kind
                ys[k, s] = 1 + 2 * kind
    return xs, ys


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, steps: int = STEPS) -> Tagger | None:
    """A tagger from the labelled spans of a bounded sample of documents; None where no text has a character.

    The sample is the first `sample` documents by a hash of id and text, half of them with a digit or an @; of each text
    SAMPLE_CHARS characters from a place that the hash chooses. Labels are the rules' spans and those of the forms put
    in, so what is learned does not depend on how many spans a table happens to hold.
    """
    text = F.col(text_col)
    h = F.abs(F.xxhash64(F.col(id_col).cast("string"), text))
    start = (h % F.greatest(F.lit(1), F.char_length(text) - SAMPLE_CHARS) + 1).cast("int")
    rows = docs.filter(F.char_length(text) > 0).select(h.alias("h"), F.substring(text, start, F.lit(SAMPLE_CHARS)).alias("t"))
    some = rows.orderBy("h", "t").limit(sample // 2)
    busy = rows.filter(F.col("t").rlike("[0-9@]")).orderBy("h", "t").limit(sample // 2)
    texts = [r.t for r in some.unionByName(busy).collect()]  # at most sample * SAMPLE_CHARS characters
    if not texts:
        return None
    tagger = Tagger.new(1 + 2 * len(KINDS))
    tagger.train(*_examples(texts, EXAMPLES, np.random.default_rng(11)), steps=steps)
    return tagger


def _emissions(pieces: list[np.ndarray], tagger: Tagger) -> tuple[np.ndarray, np.ndarray]:
    """The emissions at each place of some pieces, one after the other, and where each piece begins.

    Windows of WINDOW characters begin every STRIDE and each is asked. The emissions of the windows over a character
    are averaged, weighted by its distance from each window's edge.
    """
    count = [max(2, -(-len(c) // STRIDE)) for c in pieces]  # blocks: a window is two
    first = np.cumsum([0, *count])
    codes = np.full(first[-1] * STRIDE, PAD, np.int64)
    for at, c in zip(first.tolist(), pieces):
        codes[at * STRIDE : at * STRIDE + len(c)] = c
    codes = codes.reshape(-1, STRIDE)
    slope = (np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)) / np.float32(STRIDE + 1)).astype(np.float32)
    total = np.zeros((len(codes), STRIDE, 1 + 2 * len(KINDS)), np.float32)
    weight = np.repeat(slope, total.shape[2]).reshape(WINDOW, -1)  # a factor for each label makes one long row
    windows = np.setdiff1d(np.arange(first[-1]), first[1:] - 1)
    for w in range(0, len(windows), BLOCK):
        k = windows[w : w + BLOCK]
        e = tagger.block(np.concatenate((codes[k], codes[k + 1]), 1))
        e *= weight
        ends = np.flatnonzero(np.diff(k, append=-1) != 1) + 1  # windows of one piece follow each other
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            total[k[a] : k[b - 1] + 1] += e[a:b, :STRIDE]
            total[k[a] + 1 : k[b - 1] + 2] += e[a:b, STRIDE:]
    # the two windows over a place have STRIDE + 1 together; in a piece's first and last block there is but one
    total[first[:-1]] /= slope[:STRIDE, None]
    total[first[1:] - 1] /= slope[STRIDE:, None]
    return total.reshape(-1, total.shape[2]), first * STRIDE


def _padded(parts: list[np.ndarray], end: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Numbers and emissions of parts of about the same length, BATCH of `end` places at once; beyond each: no span."""
    order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
    while order:
        n = 1
        while n < len(order) and (n + 1) * len(parts[order[n]]) <= BATCH * end:
            n += 1
        some, order = order[:n], order[n:]
        e = np.zeros((n, len(parts[some[-1]]) + 1, 1 + 2 * len(KINDS)), np.float32)
        e[:, :, 0] = 50.0
        for j, i in enumerate(some):
            e[j, : len(parts[i])] = parts[i]
        yield some, e


def _valid(kind: int, piece: str) -> bool:
    """What an added span must be at least: a rule of its kind that needs no certain form."""
    digits = _NOT_DIGIT.sub("", piece)
    if kind == 0:
        return len(piece) > 5 and ("@" in piece or "at" in piece.lower())
    if kind == 1:
        parts = re.findall("[0-9]+", piece)
        return len(parts) in (4, 5) and all(len(p) < 4 and int(p) <= 255 for p in parts[:4])
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def _starts(labels: np.ndarray) -> list[int]:
    before = np.concatenate(([0], labels[:-1]))
    return np.flatnonzero((labels > 0) & ((labels % 2 == 1) | (before + 1 < labels) | (before > labels))).tolist()


def _lead(e: np.ndarray) -> np.ndarray:
    """How far the label of no span leads at each place; label by label, as few labels make a slow reduction."""
    top = e[:, 1].copy()
    for label in range(2, e.shape[1]):
        np.maximum(top, e[:, label], out=top)
    return e[:, 0] - top


def _decode(e: np.ndarray, texts: list[tuple[int, int, str]], tagger: Tagger, sure: float) -> list[list[Span]]:
    """The spans in texts, given emissions. Of a text: the place of its emissions, the characters, and these.

    Where the label of no span leads by the first of the tagger's limits, the likeliest path holds it, so paths between
    two such places are decoded alone; those where it leads by the second all along hold no span. Their labels are
    those of the path over the whole text. Probabilities are taken with CONTEXT places on either side.
    """
    holds, stays = tagger.limits()
    spans: list[list[Span]] = [[] for _ in texts]
    lead = _lead(e)
    stretches = []
    for d, (at, n, _) in enumerate(texts):
        of = lead[at : at + n]
        open_ = np.concatenate(([False], of <= holds, [False]))
        a, b = np.flatnonzero(open_[1:] & ~open_[:-1]), np.flatnonzero(open_[:-1] & ~open_[1:])
        weak = np.concatenate(([0], np.cumsum(of <= stays)))
        stretches += [(d, x, y) for x, y in zip(a[weak[b] > weak[a]].tolist(), b[weak[b] > weak[a]].tolist())]
    found = []
    for some, part in _padded([e[texts[d][0] + max(x - 1, 0) : texts[d][0] + min(y + 1, texts[d][1])] for d, x, y in stretches], WINDOW):
        for i, labels in zip(some, tagger.best_path(part)):
            d, x, _ = stretches[i]
            off, text = max(x - 1, 0), texts[d][2]
            for s in _starts(labels):
                kind = (int(labels[s]) - 1) // 2
                t = s + 1
                while t < len(labels) and labels[t] == 2 + 2 * kind:
                    t += 1
                first, last = off + s, off + t
                piece = text[first:last]
                kept = first + len(piece) - len(piece.lstrip()), kind, last - len(piece) + len(piece.rstrip())
                if kept[0] < kept[2] and _valid(kind, text[kept[0] : kept[2]]):
                    found.append((d, first, labels[s:t], kept))
    near = [(texts[d][0], max(first - CONTEXT, 0), min(first + len(labels) + CONTEXT, texts[d][1])) for d, first, labels, _ in found]
    for some, part in _padded([e[at + x : at + y] for at, x, y in near], WINDOW):
        for i, chance in zip(some, tagger.marginals(part)):
            d, first, labels, kept = found[i]
            at = np.arange(len(labels)) + first - near[i][1]
            if float(chance[at, labels].mean()) >= sure:
                spans[d].append(kept)
    return spans


def model_spans(texts: list[str], tagger: Tagger, sure: float = SURE) -> list[list[Span]]:
    """What the tagger finds in whole texts. Every window of every text is asked.

    One path is decoded over each text, so a span may be longer than a window and is never cut at an edge. Texts of
    PIECE characters are handled together, and a longer one in pieces: each begins, with room for the windows over it,
    where the one before holds the label of no span for certain. Where no place does, the piece grows.
    """
    spans: list[list[Span]] = [[] for _ in texts]
    holds, _ = tagger.limits()
    group: list[int] = []
    size = 0

    def flush() -> None:
        e, first = _emissions([classes_of(texts[d]) for d in group], tagger)
        for d, found in zip(group, _decode(e, [(int(at), len(texts[d]), texts[d]) for d, at in zip(group, first)], tagger, sure)):
            spans[d] = sorted(found)

    for d, text in enumerate(texts):
        if not text:
            continue
        if len(text) > PIECE:
            spans[d] = sorted(_long_spans(text, tagger, sure, holds))
            continue
        if group and size + len(text) > PIECE:
            flush()
            group, size = [], 0
        group.append(d)
        size += len(text)
    if group:
        flush()
    return spans


def _long_spans(text: str, tagger: Tagger, sure: float, holds: float) -> Iterator[Span]:
    done, size = 0, PIECE  # the places before `done` are decided
    while done < len(text):
        begin = max(0, done - CONTEXT - WINDOW) // STRIDE * STRIDE
        end = min(len(text), begin + size)
        e, _ = _emissions([classes_of(text[begin:end])], tagger)
        stop = len(text)
        if end < len(text):  # the last places lack a window or the context of a probability
            certain = np.flatnonzero(_lead(e[: end - begin - WINDOW - CONTEXT]) > holds)
            stop = begin + int(certain[-1]) if len(certain) else done
            if stop <= done:
                size *= 2
                continue
        low = begin + STRIDE if begin else 0  # the first block lacks a window
        for s, kind, t in _decode(e[low - begin :], [(0, end - low, text[low:end])], tagger, sure)[0]:
            if done <= low + s < stop:
                yield low + s, kind, low + t
        done, size = stop, PIECE


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_personal_data(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and base_sha256 are those of the rules' spans, which always stay; `spans` lists these and the ones that
    the tagger adds where they touch no other (`kind:start:end` in code points, by start and kind). Null and empty
    texts have none. Without a tagger there is nothing but the rules. Texts are handled whole, those without a digit or
    an @ as well: `anna(at)example.org` has neither. Repeated rows are judged again, an empty table gives no rows,
    other columns are left out.
    """
    find_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    out = f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            added = model_spans(texts, tagger) if tagger else [[] for _ in texts]
            base, spans = [base_spans(t) for t in texts], []
            for b, more in zip(base, added):
                spans.append(sorted(b + [m for m in more if not any(m[0] < e and s < m[2] for s, _, e in b)]))
            counts = [[sum(k == kd for _, k, _ in b) for b in base] for kd in range(len(KINDS))]
            sha = [hashlib.sha256(_listed(b).encode()).hexdigest() for b in base]
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array([_listed(s) for s in spans], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(find, out).withColumnRenamed("id", id_col)
