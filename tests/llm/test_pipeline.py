import math
import re
from collections import Counter

from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline as p
from tidemark.llm.mixing import fit

from .test_dedup import brute_components, brute_exact

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch = p.Scratch(spark, "test")
    first = scratch.table(p.known_language(spark, docs, SF))
    assert ids(first) == ids(docs)  # all of them are prose in a labelled language
    rows = [(r.doc_id, r.text) for r in first.collect()]
    second = scratch.table(p.drop_copies(spark, first, SF))
    keep = {k for _, k, _, _ in brute_exact(rows)}
    assert ids(second) == sorted(keep, key=str)
    rows = [x for x in rows if x[0] in keep]
    third = scratch.table(p.drop_near_copies(spark, second, SF))
    assert ids(third) == sorted((i for i, (_, c) in brute_components(rows).items() if i == c), key=str)
    kept = third.collect()
    fourth = scratch.table(p.mix_sources(spark, third, SF))
    held = Counter()
    for r in kept:
        held[r.source] += 1 + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    mix = fit(held, p.EVEN_SHARE * math.log(len(held)), p.MAX_REPEATS)
    times = Counter(ids(fourth))
    assert set(times) == {r.doc_id for r in kept} and max(times.values()) <= 2
    for s, n in held.items():
        drawn = sum(times[r.doc_id] * (1 + len(r.text.split())) for r in kept if r.source == s)
        assert n <= drawn <= mix.budgets[s]
    assert all(f.columns == p.DOCUMENT for f in (first, second, third, fourth))
    library = Tokenizer.from_file(public_tokenizers.path(p.VOCABULARY))
    for r in p.tokens(spark, fourth, SF).limit(50).collect():
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


def test_edges(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, text + " ", "en", "b", 5), (3, None, None, None, None), (4, "", "en", "a", 0), (5, "!!", "en", "a", 2),
            (None, text[:30], "en", None, 1), (6, "another short text", None, "b", 3), (6, "quite different words here", "en", "b", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    for _, stage in p.STAGES:
        df = p.Scratch(spark, "test").table(stage(spark, df, SF))
    assert Counter(ids(df)).keys() == {2, 6, None} and {r.text for r in df.collect()} == {text + " ", text[:30], "another short text", "quite different words here"}
    df = spark.createDataFrame([], SCHEMA)
    for _, stage in p.STAGES:
        df = p.Scratch(spark, "test").table(stage(spark, df, SF))
    assert df.collect() == []
    unlabelled = spark.createDataFrame([(1, "x", None, None, 1)], SCHEMA)
    assert ids(p.known_language(spark, unlabelled, SF)) == [1]
