import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm.queries import QUERIES
from tidemark.llm.sharding import kd_shards


def check_laws(rows, texts, leaves, slack):
    shards = defaultdict(list)
    for r in rows:
        text = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(leaves))
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
    mean = sum(r.size for r in rows) / leaves
    assert all(abs(sum(r.size for r in s) - mean) <= slack for s in shards.values())


def test_query_keeps_the_laws(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_kd_sharding"](spark, sf).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    check_laws(rows, texts, 16, 2 * max(r.size for r in rows))
    where = defaultdict(set)
    for r in rows:
        where[texts[r.doc_id]].add(r.shard)
    assert max(map(len, where.values())) == 1  # groups of equal texts are small here


def test_a_group_with_a_third_of_all_rows_is_cut(spark):
    texts = {i: "copy" * 10 if i % 3 == 0 else f"text {i} " * (i % 9) for i in range(3000)}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, node string")
    rows = kd_shards(df, {"length": F.length("text")}, leaves=7).collect()
    check_laws(rows, texts, 7, 3 * max(r.size for r in rows))


def test_equal_texts_stay_together_whatever_their_other_metadata(spark):
    texts = {i: f"text {i % 700} " * (1 + i % 7) for i in range(4200)}  # 700 texts, six copies each, lang by the row
    df = spark.createDataFrame([(i, t, i // 700) for i, t in texts.items()], "doc_id long, text string, lang int")
    rows = kd_shards(df, {"lang": F.when(F.col("lang") > 1, F.col("lang")), "length": F.length("text")}, leaves=8).collect()
    mean = sum(r.size for r in rows) / 8
    check_laws(rows, texts, 8, 0.05 * mean)
    where = defaultdict(set)
    for r in rows:
        where[texts[r.doc_id]].add(r.shard)
    assert {len(s) for s in where.values()} == {1}


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", 1.0), (2, "", 1.0), (None, "a", float("nan")), (5, "ü", 2.0)], "doc_id long, text string, size double")
    rows = kd_shards(df, {"size": F.col("size"), "none": F.lit(None)}, leaves=3).collect()
    assert sorted(r.size for r in rows) == [1, 1, 1, 2, 3] and {r.shard for r in rows} <= {0, 1, 2}
    assert kd_shards(df.limit(0), {"size": F.col("size")}, leaves=3).collect() == []
    assert {r.shard for r in kd_shards(df, {}, target_bytes=1000).collect()} == {0}
    with pytest.raises(TypeError):
        kd_shards(df, {})
