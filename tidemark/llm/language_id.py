"""Language identification by interpolated Kneser-Ney character models, one per language.

The n-grams of all languages stand in sorted arrays of hashes, each with its log-probability in every language, so one
binary search serves all languages. The language with the lowest cross-entropy per character wins; a document whose
cross-entropy is beyond what the calibration documents of that language show is rejected.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import find_package
from tidemark.llm.words import mix64, slices

ORDER = 4
#: The models are fitted on about this many labelled documents a language, whole texts, and calibrated on others.
SAMPLE = 2000
#: A language that has no others is calibrated by models that each leave out one of so many parts of its documents.
FOLDS = 4
#: A language with fewer documents to calibrate on takes the variances of all languages for as many documents as this.
CALIBRATION = 20
#: A document is rejected beyond so many standard deviations between documents and, as it is short, of its characters'
#: mean, so that hardly any document of a learned language is. README has the rates by length.
LIMIT, NOISE = 8.0, 4.0
#: Text scored at once within a task; a longer one is scored alone, whole.
SLICE_BYTES = 1 << 19
#: Steepness of the score: the scores of two languages differ by this power of e for one nat per character.
STEEP = 8.0

_MIX = mix64(np.arange(1, ORDER + 1, dtype=np.uint64)) | np.uint64(1)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def plain_characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, where each text begins, how many letters it has.

    Lower case; every run of other characters than letters is one space. Before each text stand ORDER - 1 spaces, so
    that no n-gram of a text reaches into another, and one behind its last letter.
    """
    codes = [np.frombuffer(unicodedata.normalize("NFC", t or "").lower().encode("utf-32-le"), np.uint32) for t in texts]
    space = np.full(ORDER - 1, 32, np.uint32)
    flat = np.concatenate([x for c in codes for x in (space, c, space[:1])])
    letter = _is_letter()[flat]
    begins = np.cumsum([0, *(len(c) + ORDER for c in codes)])
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first of each run of others
    keep[np.add.outer(begins[:-1], np.arange(ORDER - 1))] = True
    kept = np.concatenate(([0], np.cumsum(keep)))[begins]
    letters = np.concatenate(([0], np.cumsum(letter)))[begins]
    return np.where(letter, flat, np.uint32(32))[keep], kept, np.diff(letters)


def _hashes(flat: np.ndarray, order: int) -> np.ndarray:
    """Of the n-gram that ends at each place; places before the first are spaces."""
    padded = np.concatenate((np.full(order - 1, 32, np.uint32), flat)).astype(np.uint64)
    total = np.zeros(len(flat), np.uint64)
    for j in range(order):
        total += padded[order - 1 - j : len(padded) - j] * _MIX[j]
    return total


def _hash(gram: str) -> int:
    return sum(ord(c) * int(m) for c, m in zip(reversed(gram), _MIX)) & (2**64 - 1)


@dataclass
class Table:
    """Sorted hashes and a row of values for each, one value per language."""

    keys: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(rows: dict[str, list[float]], n: int) -> Table:
        keys = np.array([_hash(g) for g in rows], np.uint64)
        order = np.argsort(keys)
        return Table(keys[order], np.array(list(rows.values()), np.float32).reshape(-1, n)[order])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == hashes


@dataclass
class Model:
    """Its size follows the number of n-grams in the bounded sample, not the corpus."""

    languages: list[str]
    grams: list[Table]  # by order, from 1: log-probability of the last character after the others
    contexts: list[Table]  # by order: log of the share that the lower order gets after this context
    unseen: float
    limits: dict[str, tuple[float, float, float]] = field(default_factory=dict)  # mean, variance between, variance within

    def log_probabilities(self, flat: np.ndarray) -> np.ndarray:
        """For each place and language."""
        out = np.zeros((len(flat), len(self.languages)), np.float32)
        left = np.arange(len(flat))
        for order in range(len(self.grams), 0, -1):
            h = _hashes(flat, order)[left]
            at, hit = self.grams[order - 1].find(h)
            out[left[hit]] += self.grams[order - 1].values[at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            # the context's hash as of an n-gram that ends one place earlier
            before = np.concatenate((np.zeros(1, np.uint64), _hashes(flat, order - 1)[:-1])) if order > 1 else np.zeros(len(flat), np.uint64)
            if order > 1:
                before[0] = _hash(" " * (order - 1))
            at, hit = self.contexts[order - 1].find(before[left])
            out[left[hit]] += self.contexts[order - 1].values[at[hit]]
        out[left] += np.float32(self.unseen)
        return out


def kneser_ney(counts: dict[str, dict[str, int]]) -> Model:
    """The models of all languages from their n-gram counts of the highest order."""
    languages = sorted(counts)
    n, seen = len(languages), {g[-1] for c in counts.values() for g in c}
    unseen = -math.log(len(seen) + 1)
    grams: list[dict[str, list[float]]] = [{} for _ in range(ORDER)]
    contexts: list[dict[str, list[float]]] = [{} for _ in range(ORDER)]
    by_order = []  # by language: for each order the counts, lower orders counting the different characters to the left
    for lang in languages:
        orders = [Counter(counts[lang])]
        for _ in range(ORDER - 1):
            orders.append(Counter(g[1:] for g in orders[-1]))
        by_order.append(orders[::-1])
    for k in range(ORDER):
        table, share = grams[k], contexts[k]
        for g in {g for orders in by_order for g in orders[k]}:
            table[g] = [0.0] * n
        for i, orders in enumerate(by_order):
            count = orders[k]
            ones = sum(1 for c in count.values() if c == 1)
            twos = sum(1 for c in count.values() if c == 2)
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total, kinds = defaultdict(int), defaultdict(int)
            for g, c in count.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            rest = {h: discount * kinds[h] / total[h] for h in total}
            for h, x in rest.items():
                share.setdefault(h, [0.0] * n)[i] = math.log(x)
            for g, row in table.items():
                h, lower = g[:-1], unseen if k == 0 else _lower(grams, contexts, g[1:], i, unseen)
                own = max(count.get(g, 0) - discount, 0) / total[h] if h in rest else 0.0
                row[i] = math.log(own + rest.get(h, 1.0) * math.exp(lower))
    return Model(languages, [Table.of(t, n) for t in grams], [Table.of(t, n) for t in contexts], unseen)


def _lower(grams, contexts, g: str, i: int, unseen: float) -> float:
    """The log-probability of g's last character in language i by the orders that are ready."""
    log = 0.0
    while g:
        if g in grams[len(g) - 1]:
            return log + grams[len(g) - 1][g][i]
        log += contexts[len(g) - 1].get(g[:-1], {i: 0.0})[i]
        g = g[1:]
    return log + unseen


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By language, and by part where the batches have one."""
    for batch in batches:
        counts = defaultdict(Counter)
        folds = batch["fold"].to_pylist() if "fold" in batch.schema.names else [-1] * len(batch)
        for lang, fold, text in zip(batch["lang"].to_pylist(), folds, batch["text"].to_pylist()):
            flat, _, _ = plain_characters([text])
            s = "".join(map(chr, flat.tolist()))
            counts[lang, fold].update(s[i : i + ORDER] for i in range(len(s) - ORDER + 1))
        rows = [(lang, fold, g, n) for (lang, fold), c in counts.items() for g, n in c.items()]
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([],) * 4, kinds)], ["lang", "fold", "gram", "n"])


def _scores(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs = np.array([*model.languages, "und"], object)
    limits = np.array([model.limits.get(x, (math.inf, 0, 0)) for x in model.languages] + [(math.inf, 0, 0)])
    for batch in batches:
        for a, b in slices(batch["text"], SLICE_BYTES):
            flat, begins, letters = plain_characters(batch["text"].slice(a, b - a).to_pylist())
            if not model.languages:
                rest = [pa.array(x) for x in (["und"] * (b - a), np.zeros(b - a), np.zeros(b - a), np.zeros(b - a), np.diff(begins), letters == 0)]
                names = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(a, b - a) for c in names), *rest], [*names, "lang_pred", "score", "entropy", "within", "n_chars", "rejected"])
                continue
            logp = model.log_probabilities(flat)
            logp[np.add.outer(begins[:-1], np.arange(ORDER - 1))] = 0
            n = np.maximum(np.diff(begins) - (ORDER - 1), 1)
            entropy = -np.add.reduceat(logp, begins[:-1], axis=0, dtype=np.float64) / n[:, None]
            best = entropy.argmin(axis=1)
            least = entropy[np.arange(len(n)), best]
            score = 1 / np.exp(STEEP * (least[:, None] - entropy)).sum(axis=1)
            own = logp[np.arange(len(flat)), np.repeat(best, np.diff(begins))].astype(np.float64)
            within = np.maximum(np.add.reduceat(own * own, begins[:-1]) / n - least**2, 0)
            none = letters == 0
            best[none] = len(model.languages)
            mean, between, inside = limits[best].T
            rejected = none | (least > mean + np.sqrt(LIMIT**2 * between + NOISE**2 * 4 * inside / n))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c].slice(a, b - a) for c in batch.schema.names if c != "text"), pa.array(langs[best], pa.string()), pa.array(np.where(none, 0.0, score)),
                 pa.array(least), pa.array(within), pa.array(n, pa.int64()), pa.array(rejected)],
                [*(c for c in batch.schema.names if c != "text"), "lang_pred", "score", "entropy", "within", "n_chars", "rejected"],
            )


_SCORE_SCHEMA = "lang_pred string, score double, entropy double, within double, n_chars long, rejected boolean"


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, calibrate: bool = True) -> Model:
    """The models of every language in `labelled`; rows with a null text or language teach nothing. Without any labelled
    text the model knows no language: it predicts `und` with score 0 for all. Without `calibrate` it rejects nothing but
    texts without letters, and the models that only the limits need are not made.

    A language with much more than `sample` documents is thinned evenly by a hash to about as many, and a quarter as many
    others calibrate it. A smaller one is learned from all its documents and calibrated by models that leave a part out.
    """
    find_package(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna(subset=["text", "lang"])
    sizes = rows.groupBy("lang").count().collect()
    if not sizes:
        return Model([], [], [], 0.0)
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / (1 << 30)
    enough = F.lit(1.0)
    for r in sizes:
        if r["count"] > 1.25 * sample:
            enough = F.when(F.col("lang") == r.lang, F.lit(sample / r["count"])).otherwise(enough)
    # copies of a text are in one part
    fold = F.when(enough < 1, F.lit(-1)).otherwise(F.pmod(F.xxhash64("text"), F.lit(FOLDS))).cast("int").alias("fold")
    counts = defaultdict(lambda: defaultdict(dict))  # by part and language
    grams = rows.filter(place < enough).select("lang", fold, "text").mapInArrow(_count_grams, "lang string, fold int, gram string, n long")
    for r in grams.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r.fold][r.lang][r.gram] = r.n

    def without(part: int | None) -> dict[str, Counter]:
        total = defaultdict(Counter)
        for f, by_lang in counts.items():
            for lang, grams in by_lang.items() if f != part else ():
                total[lang].update(grams)
        return total

    model = kneser_ney(without(None))
    if not calibrate:
        return model
    models = {-1: model} | {f: kneser_ney(rest) for f in counts if f >= 0 and (rest := without(f))}
    others = rows.filter((enough == 1) | ((place >= enough) & (place < 1.25 * enough))).select("lang", fold, "text")
    others = others.filter(F.col("fold").isin(list(models)))
    right = _scored(others, models, "lang string, fold int").filter("lang_pred = lang").groupBy("lang")
    figures = right.agg(F.count("*").alias("n"), F.avg("entropy").alias("mean"), F.var_samp("entropy").alias("between"), F.avg("within").alias("within")).collect()
    model.limits = _limits(model, {r.lang: (r.n, r["mean"], r.between or 0.0, r.within) for r in figures})
    return model


def _limits(model: Model, figures: dict[str, tuple[int, float, float, float]]) -> dict[str, tuple[float, float, float]]:
    """For every language, from its calibration documents' number, mean entropy, variance between and variance within.

    The mean is the language's own, as a model that has seen little fits its language less well; the variances lean on
    those of all languages as on CALIBRATION more documents, and allow for the error of that mean, so the fewer documents
    there are the more. A language without any is judged by chance alone: its text must cost less than characters drawn
    evenly from all that were seen.
    """
    freedom, held = sum(n - 1 for n, *_ in figures.values()), sum(n for n, *_ in figures.values())
    spread = sum((n - 1) * between for n, _, between, _ in figures.values()) / freedom if freedom else 0.0
    inside = sum(n * within for n, *_, within in figures.values()) / held if held else 0.0
    limits = {lang: (-model.unseen, 0.0, 0.0) for lang in model.languages}
    for lang, (n, mean, between, within) in figures.items():
        between = ((n - 1) * between + CALIBRATION * spread) / (n - 1 + CALIBRATION) * (1 + 1 / n)
        within = (n * within + CALIBRATION * inside) / (n + CALIBRATION)
        limits[lang] = (mean, between, within)
    return limits


def _scored(docs: DataFrame, models: dict[int, Model], schema: str) -> DataFrame:
    """Each row by the model of its fold, or by the only one where rows have none."""
    find_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f, model in held.value.items():
                part = batch.filter(pc.equal(batch["fold"], f)) if "fold" in batch.schema.names else batch
                yield from _scores(model, iter([part] if len(part) else []))

    return docs.mapInArrow(run, f"{schema}, {_SCORE_SCHEMA}")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score (0 to 1), entropy (nats per character), rejected.

    A null text or one without a letter is `und` with score 0 and rejected. Languages that tie go by name. Whole texts are
    scored where they are read; the only thing that moves is the model. Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _scored(rows, {-1: model}, f"doc_id {kind}").select("doc_id", "lang_pred", "score", "entropy", "rejected")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that the model does not reject, with their columns."""
    find_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch[text_col]], ["text"])
            rejected = [x for scored in _scores(held.value, iter([texts])) for x in scored["rejected"].to_pylist()]
            yield batch.filter(pa.array([not x for x in rejected], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
