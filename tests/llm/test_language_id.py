import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.language_id import ORDER, _count_grams, kneser_ney, plain_characters, predict, train
from tidemark.llm.queries import QUERIES

EN = "the quick brown fox jumps over the lazy dog and then it runs away from the other animals in the field"
DE = "der schnelle braune fuchs springt über den faulen hund und dann läuft er vor den anderen tieren weg"


def labelled(spark):
    return spark.createDataFrame(
        [(i, EN[i % 7 :], "en", 1.0) for i in range(200)] + [(500 + i, DE[i % 7 :], "de", 1.0) for i in range(200)], "doc_id long, text string, lang string, score double"
    )


def test_characters_are_letters_and_single_spaces():
    flat, begins, letters = plain_characters(["A, b!c ", None, "é́"])
    texts = ["".join(map(chr, flat[a:b])) for a, b in zip(begins, begins[1:])]
    assert texts == ["   a b c ", "   ", "   é "] and letters.tolist() == [3, 0, 1]


def test_probabilities_sum_to_one(spark):
    import numpy as np
    import pyarrow as pa

    counts = {"en": {}, "de": {}}
    for lang, text in (("en", EN), ("de", DE)):
        for batch in _count_grams([pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([text])], ["lang", "text"])]):
            counts[lang] = dict(zip(batch["gram"].to_pylist(), batch["n"].to_pylist()))
    model = kneser_ney(counts)
    alphabet = sorted({g[-1] for c in counts.values() for g in c} | {"ж"})
    for context in ("the", " th", "zzz", "ert", "жжж", "   "):
        probability = np.zeros(2)
        for c in alphabet:
            flat = np.array([ord(x) for x in context + c], np.uint32)
            probability += np.exp(model.log_probabilities(flat)[ORDER - 1].astype(float))
        assert probability == pytest.approx([1, 1], abs=1e-4)


def test_predictions_do_not_depend_on_neighbours_and_edges_are_defined(spark):
    model = train(labelled(spark))
    rows = [(1, EN[:40], "x"), (2, None, "x"), (3, "", "x"), (4, "123 !!", "x"), (5, DE[:40], "x"), (6, "ж", "x"), (1, EN[:40], "y"), (7, (EN + " ") * 3000, "z"), (None, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = predict(docs.coalesce(1), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got][:5] == [(1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "de")]
    assert got[0][1:] == got[6][1:] and got[7].lang_pred == "en" and not got[7].rejected and len(got) == 9
    assert all(0 <= r.score <= 1 for r in got) and [r.rejected for r in got[1:4]] == [True] * 3
    assert predict(docs.filter("doc_id = 5"), model).collect() == [got[4]]
    assert predict(docs.limit(0), model).collect() == []


def test_rejection_of_what_no_language_explains(spark):
    model = train(labelled(spark))
    noise = "".join(chr(0x4E00 + i * 37 % 9000) for i in range(400))
    docs = spark.createDataFrame([(1, noise), (2, EN)], "doc_id long, text string")
    assert [r.rejected for r in predict(docs, model).orderBy("doc_id").collect()] == [True, False]
    assert math.isfinite(predict(docs, model).agg(F.max("entropy")).first()[0])


def test_nothing_to_learn_from(spark):
    for rows in (labelled(spark).limit(0), labelled(spark).withColumn("lang", F.lit(None).cast("string"))):
        for calibrate in (True, False):
            model = train(rows, calibrate=calibrate)
            docs = spark.createDataFrame([(1, EN), (2, None), (3, "12")], "doc_id long, text string")
            got = predict(docs, model).orderBy("doc_id").collect()
            assert [(r.lang_pred, r.score, r.rejected) for r in got] == [("und", 0.0, False), ("und", 0.0, True), ("und", 0.0, True)]
            assert predict(docs.limit(0), model).collect() == []


def test_the_query_without_documents_or_labels(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    docs.withColumn("lang", F.lit(None).cast("string")).write.parquet(str(tmp_path / "bare" / "documents.parquet"))
    run = QUERIES["op10_language_id"]
    assert run(spark, str(tmp_path / "none")).collect() == []
    got = run(spark, str(tmp_path / "bare")).collect()
    assert len(got) == docs.count() and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def plain_kneser_ney(texts, order):
    """Log-probabilities by the definition: counts at the highest order, kinds of predecessors below, even chances last."""
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        for i in range(len(t) - order + 1):
            grams[order][t[i : i + order]] += 1
    for k in range(order - 1, 0, -1):
        for g in grams[k + 1]:
            grams[k][g[1:]] += 1

    def probability(g, symbols):
        if not g:
            return 1 / symbols
        seen = {x: n for x, n in grams[len(g)].items() if x[:-1] == g[:-1]}
        lower = probability(g[1:], symbols)
        if not seen:
            return lower
        total = sum(seen.values())
        once, twice = (sum(n == k for n in grams[len(g)].values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once and twice else 0.5
        return max(seen.get(g, 0) - discount, 0) / total + discount * len(seen) / total * lower

    return probability


def test_probabilities_are_those_of_the_definition():
    texts = ["   abrakadabra  ab ra", "   kadabra dabra a"]
    counts = Counter(t[i : i + ORDER] for t in texts for i in range(len(t) - ORDER + 1))
    model = kneser_ney({"x": counts})
    want = plain_kneser_ney(texts, ORDER)
    symbols = round(math.exp(-model.unseen))
    for text in ("   abra kadab", "   zzz ab", "   raa dabr kkab"):
        got = model.log_probabilities(np.array([ord(c) for c in text]))[:, 0]
        for i in range(ORDER - 1, len(text)):
            assert abs(got[i] - math.log(want(text[i - ORDER + 1 : i + 1], symbols))) < 1e-4, (text, i)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op10_language_id"](spark, sf).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in got) >= 0.99 * len(got) > 250


def test_a_rare_language_has_a_limit_and_is_learned_whole(spark):
    model = train(labelled(spark).limit(60))  # too few for 20 calibration documents a language
    assert set(model.limits) == set(model.languages)
    rare = "ο γρηγορος σκυλος τρεχει στο μεγαλο πρασινο λιβαδι και κοιταζει τα ζωα του αγρου"
    noise = "".join(chr(0x4E00 + i * 37 % 9000) for i in range(400))
    for i in range(2):
        model = train(labelled(spark).unionByName(spark.createDataFrame([(9000 + i, rare, "el", 1.0)], labelled(spark).schema)))
        docs = spark.createDataFrame([(1, noise), (2, EN), (3, rare)], "doc_id long, text string")
        assert [(r.lang_pred, r.rejected) for r in predict(docs, model).orderBy("doc_id").collect()][1:] == [("en", False), ("el", False)]
        assert predict(docs, model).filter("doc_id = 1").first().rejected
    model = train(spark.createDataFrame([(1, EN, "en")], "doc_id long, text string, lang string"))
    assert [r.rejected for r in predict(docs, model).orderBy("doc_id").collect()] == [True, False, True]


def test_short_texts_of_random_letters_are_rejected():
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tidemark.llm.language_id import _limits, _scores

    by = {}
    for r in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text", "lang"]).to_pylist():
        by.setdefault(r["lang"], []).append(r["text"] or "")

    def scored(model, texts):
        return pa.Table.from_batches(_scores(model, iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))).to_pylist()

    counts = {}
    for lang in ("en", "de", "fr"):
        batch = pa.RecordBatch.from_arrays([pa.array([lang] * 300), pa.array(by[lang][:300])], ["lang", "text"])
        counts[lang] = {g: n for b in _count_grams([batch]) for g, n in zip(b["gram"].to_pylist(), b["n"].to_pylist())}
    model, figures = kneser_ney(counts), {}
    for lang in counts:
        got = [r for r in scored(model, by[lang][300:400]) if r["lang_pred"] == lang]
        mean = sum(r["entropy"] for r in got) / len(got)
        figures[lang] = (len(got), mean, sum((r["entropy"] - mean) ** 2 for r in got) / (len(got) - 1), sum(r["within"] for r in got) / len(got))
    model.limits = _limits(model, figures)
    rng = random.Random(1)
    foreign = scored(model, ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(23)) for _ in range(300)])
    own = scored(model, [x[:100] for lang in counts for x in by[lang][400:] if len(x) >= 200][:1000])
    assert sum(r["rejected"] for r in foreign) > 0.9 * len(foreign) and sum(r["rejected"] for r in own) < 0.01 * len(own)
