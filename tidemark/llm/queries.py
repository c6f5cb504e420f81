"""The operators of this package on the test tables, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.alignment import Pair, align_tokens
from tidemark.llm.bpe import encode, read_vocabulary
from tidemark.llm.chat import CONTROL, format_branches, loss_text, read_turns
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.language_id import predict, train
from tidemark.llm.minhash import near_dedup
from tidemark.llm.mixing import BLOCK_TOKENS, count_words, draw
from tidemark.llm.mtree import top_k
from tidemark.llm.pii import find_personal_data
from tidemark.llm.pii import train as train_tagger
from tidemark.llm.shared import Scratch
from tidemark.llm.sharding import kd_shards
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.warc import look_up, read_records, url_key, write_archives, write_index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op4_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, vocabulary, decoded_col="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = train(docs.filter(~held_out), calibrate=False)  # this query rejects nothing
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLES["op1_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT win, min(doc_id) AS first FROM g GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN m USING (win) WHERE first < doc_id),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, count(*) AS kept, string_agg(word, ' ' ORDER BY i) AS t FROM e ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    node = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    tree = F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("id"))  # rows without conv_id are a conversation too
    messages = said.select(tree.alias("tree"), node.alias("node"), "role", "text", F.lit(0.0).alias("score"))
    messages = messages.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))  # a conversation without branches
    done = format_branches(messages).select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("lost"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        F.when(~F.col("tree.none"), F.col("tree.id")).alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _escaped(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for c in CONTROL:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


ORACLES["op2_chat_formatting"] = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS i FROM c),
l AS (SELECT *, length({_escaped("text")}) + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4
             ELSE coalesce(25 + length({_escaped("role")}), 18) END AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(n))::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
"""


@query
def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    dimensions = {
        "length": F.log2(F.octet_length(text) + 1), "bytes_per_character": F.octet_length(text) / F.greatest(F.char_length(text), F.lit(1)),
        "language": F.crc32(F.coalesce(F.col("lang"), F.lit(""))),
    }
    return kd_shards(table(spark, sf_dir, "documents"), dimensions, leaves=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    budget = docs.agg(F.sum(count_words(F.col("text")))).first()[0]  # as many tokens as there are
    return draw(docs, count_words(F.col("text")), max_repeats=2.0, budget=budget)


def _power(exponent: str) -> str:
    return f"list_transform(p, lambda x: x ** {exponent})"


ORACLES["op7_temperature_mixing"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, 1 + len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents),
s AS (SELECT source, sum(n)::BIGINT AS held FROM d GROUP BY source),
q AS (SELECT sum(held)::DOUBLE AS total, list(held ORDER BY source) AS h, list(held / (SELECT sum(held) FROM s) ORDER BY source) AS p, 0.95 * ln(count(*)) AS target FROM s),
e AS (SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
      UNION ALL SELECT step + 1, CASE WHEN ok THEN (low + high) / 2 ELSE low END, CASE WHEN ok THEN high ELSE (low + high) / 2 END
      FROM (SELECT step, low, high, -list_sum(list_transform(w, lambda x: x / list_sum(w) * ln(x / list_sum(w)))) >= target AS ok
            FROM (SELECT step, low, high, target, {_power("((low + high) / 2)")} AS w FROM e, q)) WHERE step < 40),
r AS (SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
      UNION ALL SELECT step + 1, CASE WHEN ok THEN (low + high) / 2 ELSE low END, CASE WHEN ok THEN high ELSE (low + high) / 2 END
      FROM (SELECT step, low, high, list_max(list_transform(list_zip(w, h), lambda x: x[1] / list_sum(w) * total / x[2])) > 2 AS ok
            FROM (SELECT step, low, high, h, total, {_power("((low + high) / 2)")} AS w FROM r, q)) WHERE step < 40),
a1 AS (SELECT CASE WHEN -list_sum(list_transform(p, lambda x: x * ln(x))) >= target THEN 1.0 ELSE (SELECT round(low, 6) FROM e WHERE step = 40) END AS a FROM q),
a AS (SELECT CASE WHEN list_max(list_transform(list_zip(w, h), lambda x: x[1] / list_sum(w) * total / x[2])) > 2 THEN (SELECT round(low, 6) FROM r WHERE step = 40) ELSE a END AS a
      FROM (SELECT a, h, total, {_power("a")} AS w FROM a1, q)),
b AS (SELECT source, held, floor((held / total) ** a / sum((held / total) ** a) OVER () * total + 1e-6)::BIGINT AS budget FROM s, q, a),
plan AS (SELECT source, budget // held AS passes, budget % held AS rest, 1 + held // {BLOCK_TOKENS} AS n_blocks FROM b),
f AS (SELECT d.*, passes, rest, ('0x' || substr(md5('mix:' || doc_id), 1, 8))::BIGINT % n_blocks AS block FROM d JOIN plan USING (source)),
k AS (SELECT source, block, passes, rest, sum(n)::BIGINT AS bytes, unnest(range(0, passes + 1)) AS epoch FROM f GROUP BY source, block, passes, rest),
o AS (SELECT *, row_number() OVER w - 1 AS block_place, sum(bytes) OVER w - bytes AS before FROM k
      WINDOW w AS (PARTITION BY source, epoch ORDER BY ('0x' || substr(md5('mix:' || epoch || ':' || source || ':' || block), 1, 8))::BIGINT, block)),
m AS (SELECT *, CASE WHEN epoch < passes THEN bytes ELSE least(bytes, rest - before) END AS room FROM o),
z AS (SELECT doc_id, f.source, n, epoch, block_place, room, bytes, sum(n) OVER (PARTITION BY f.source, f.block, epoch
             ORDER BY ('0x' || substr(md5('mix:' || epoch || ':' || doc_id), 1, 8))::BIGINT, doc_id ROWS UNBOUNDED PRECEDING) AS upto
      FROM f JOIN m ON f.source = m.source AND f.block = m.block WHERE room > 0)
SELECT doc_id, source, n AS n_tokens, epoch::INT AS epoch, block_place::INT AS block_place FROM z WHERE room = bytes OR upto <= room
"""


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, scratch = table(spark, sf_dir, "pages"), Scratch(spark, "archives")
    captures = scratch.table(write_archives(pages, f"{scratch.folder}/warc"))
    parts = write_index(captures, f"{scratch.folder}/index")
    wanted = pages.select("page_id", url_key(F.col("url")).alias("key"))
    return read_records(look_up(wanted, parts)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS response FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM q
"""


@query
def op6_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op6_mtree_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


#: The remainders of CRC-32 by its rule (polynomial 0xEDB88320), then a run's checksum byte by byte.
ORACLES["op11_spelling_variants"] = r"""
WITH RECURSIVE c AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda v, b: xor(v >> 1, (v & 1) * 3988292384), i) AS v FROM range(256) r(i))),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
d AS (SELECT run, count(*) AS k, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b FROM r GROUP BY doc_id, run),
h AS (SELECT run, k, xor(list_reduce(list_transform(range(0, octet_length(b)), lambda i: ('0x' || hex(b)[2 * i + 1:2 * i + 2])::BIGINT),
             lambda v, x: xor(v >> 8, t[1 + (xor(v, x) & 255)]), 4294967295), 4294967295) AS h FROM d, c),
o AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
w AS (SELECT word, sum(k)::BIGINT AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
s AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n FROM s a JOIN s b USING (rest, i) WHERE a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM s a JOIN w b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM s a JOIN w b ON a.rest = b.word),
g AS (SELECT word, count(*) AS n_near, max(n) AS best_n, arg_min(near, (-n, encode(near))) AS best FROM p GROUP BY word),
f AS (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n FROM w LEFT JOIN g USING (word)),
z AS (SELECT word, word AS root FROM f WHERE form IS NULL UNION ALL SELECT f.word, z.root FROM f JOIN z ON f.form = z.word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN z USING (word)
"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = Pair.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return align_tokens(table(spark, sf_dir, "documents"), pair)


@query
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_personal_data(docs, train_tagger(docs))
