"""A corpus pipeline: each stage reads what its predecessor kept, as Parquet.

Language identification, exact duplicates, near duplicates, mixing of sources, tokens. All stages but the last give the
columns of documents. Rows that share a doc_id are one document: where a stage keeps it, it keeps its different texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encode, read_vocabulary
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.language_id import keep_known, train
from tidemark.llm.minhash import near_dedup
from tidemark.llm.mixing import count_words, draw
from tidemark.llm.shared import Scratch, delete_spaces, is_empty

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]

#: The mixture's entropy as a share of that of equal weights, and how often a source may be drawn at most.
EVEN_SHARE, MAX_REPEATS = 0.9, 2.0
VOCABULARY = "word_bpe_49k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter or are like no language the labelled documents show.

    Where nothing is labelled there is nothing to be unlike, and all documents stay.
    """
    docs = docs.select(DOCUMENT)
    if is_empty(docs.filter("text IS NOT NULL AND lang IS NOT NULL")):
        return docs
    return keep_known(docs, train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    docs = docs.select(*DOCUMENT, F.sha2(delete_spaces(F.coalesce("text", F.lit(""))), 256).alias("digest"))
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("id"), "text_sha256")
    same = (docs["digest"] == kept["text_sha256"]) & docs["doc_id"].eqNullSafe(kept["id"])
    repeats = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    left = docs.join(kept, same, "left_semi")
    if not is_empty(repeats):  # rows that repeat a doc_id with its text
        left = left.dropDuplicates(["doc_id", "digest"])
    return left.select(DOCUMENT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that links of similar word runs join."""
    kept = near_dedup(docs).filter("kept").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["id"]), "left_semi").select(DOCUMENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and documents of smaller sources again until the mixture is even enough."""
    drawn = draw(docs, count_words(F.col("text")), even_share=EVEN_SHARE, max_repeats=MAX_REPEATS)
    passes = drawn.groupBy(F.col("doc_id").alias("id")).agg((F.max("epoch") + 1).alias("passes"))
    often = docs.join(passes, docs["doc_id"].eqNullSafe(passes["id"]))
    return often.withColumn("pass", F.explode(F.sequence(F.lit(1), "passes"))).select(DOCUMENT)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, how many there are, and the ids decoded."""
    vocabulary = read_vocabulary(public_tokenizers.path(VOCABULARY))
    return encode(docs, vocabulary, decoded_col="decoded").withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", drop_copies),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokens),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages. Each stage's result is written to the shared folder and read again."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
