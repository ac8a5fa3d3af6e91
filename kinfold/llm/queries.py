"""Queries of this subpackage over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.shared import batches_of_bytes, documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(batches_of_bytes(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return register


@query("op1_fm_index_decontaminate")
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.decontaminate import find_contamination, n_hit

    found = find_contamination(documents(spark, folder), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", F.col("n_words").cast("bigint"), n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"))


@query("op5_ngram_jaccard_join")
def jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.jaccard import similar_documents

    return similar_documents(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


@query("op4_histogram_sort_shards")
def shards(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.sharding import shard_by_bytes

    return shard_by_bytes(documents(spark, folder), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op10_warc_assembly")
def captures(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.warc import round_trip

    found = round_trip(spark, table(spark, folder, "pages"))
    page = lambda record: F.col(f"{record}.fields")["pageid"].cast("bigint")
    return found.select(
        page("metadata").alias("page_id"),
        F.coalesce("capture.payload_bytes", "revisited.capture.payload_bytes").alias("payload_bytes"),
        F.coalesce("capture.payload_digest", "revisited.capture.payload_digest").alias("payload_digest"),
        F.col("capture.kind").alias("record_type"), page("revisited.metadata").alias("refers_to"))


@query("op6_token_id_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.token_files import round_trip

    return round_trip(spark, documents(spark, folder)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_two_tier_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.token_counts import LIMIT, count_tokens

    return count_tokens(documents(spark, folder)).withColumn("over_limit", F.col("n_tokens") > LIMIT)


@query("op3_bpe_tree_round_trip")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.bpe_tree import decode, encode

    decoded = decode(encode(documents(spark, folder)))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_tokeniser_fertility")
def fertility(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.fertility import measure

    return measure(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_toxic_segments")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.toxicity import HELD_OUT_FOLD, fold, score, train

    docs = documents(spark, folder)
    scored = score(docs, train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", F.coalesce(fold() == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op8_disclosure_sanitise")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.disclosure import KINDS, TERM_KIND, find_personal_data, joined_spans, span_text

    base = [span_text(k, k) for k in KINDS]
    return find_personal_data(documents(spark, folder)).select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(*base), 256).alias("base_sha256"),
        joined_spans(*base, span_text(TERM_KIND, "terms")).alias("spans"))


@query("op11_vector_codes", sql="""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v,
         len(embedding) // 16 AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, w, p, v[p * w + 1 : (p + 1) * w] AS x FROM kept, (SELECT unnest(range(16)) AS p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
near0 AS MATERIALIZED (
  SELECT t.vec_id, t.p, any_value(t.x) AS x,
         min(64 * list_sum([(t.x[i] - b.x[i]) * (t.x[i] - b.x[i]) for i in range(1, t.w + 1)]) + b.e) % 64 AS e
  FROM parts t JOIN book0 b USING (p) GROUP BY t.vec_id, t.p),
mean1 AS (
  SELECT p, e, i, sum(x[i]) AS s, count(*) AS n
  FROM near0, (SELECT unnest(range(1, (SELECT max(w) FROM parts) + 1)) AS i) GROUP BY p, e, i),
book1 AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book0 b LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM mean1 GROUP BY p, e) m USING (p, e)),
near1 AS MATERIALIZED (
  SELECT t.vec_id, t.p, any_value(t.x) AS x,
         min(64 * list_sum([(t.x[i] - b.x[i]) * (t.x[i] - b.x[i]) for i in range(1, t.w + 1)]) + b.e) % 64 AS e
  FROM parts t JOIN book1 b USING (p) GROUP BY t.vec_id, t.p),
mean2 AS (
  SELECT p, e, i, sum(x[i]) AS s, count(*) AS n
  FROM near1, (SELECT unnest(range(1, (SELECT max(w) FROM parts) + 1)) AS i) GROUP BY p, e, i),
book2 AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book1 b LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM mean2 GROUP BY p, e) m USING (p, e)),
near2 AS MATERIALIZED (
  SELECT t.vec_id, any_value(t.label) AS label, t.p,
         min(64 * list_sum([(t.x[i] - b.x[i]) * (t.x[i] - b.x[i]) for i in range(1, t.w + 1)]) + b.e) AS m
  FROM parts t JOIN book2 b USING (p) GROUP BY t.vec_id, t.p),
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', CAST(m % 64 AS INTEGER)), '' ORDER BY p) AS code,
         CAST(sum(m // 64) AS BIGINT) AS error FROM near2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded""")
def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.vector_codes import code_table

    return code_table(table(spark, folder, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op13_embedding_whitening")
def whitening(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.whitening import whiten

    # Deviations beyond a long (some 10^8 vectors) are null here; the operator itself has them as decimals.
    return whiten(table(spark, folder, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@query("op12_chat_formatting", sql=r"""
WITH turns AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(regexp_replace(text, '(<\\*)(/?s>|\|turn\|>|\|end\|>)', '\1\\\2', 'g'),
                           '(\[\\*)(/?INST\])', '\1\\\2', 'g') AS shown FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       CAST(sum(length('<|turn|>') + length(role) + 1 + length(shown) + length('<|end|>') + 1) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""")
def chat(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.llm.chat import round_trip

    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)],
                                 "conv_id bigint, turn bigint, role string, text string")
    given = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return round_trip(given.unionByName(more))
