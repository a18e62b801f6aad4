"""One registered query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoflux.llm import (alignment, buckets, chat_format, common, decision_list, feistel, line_dedup, pair_index, rule_ensemble,
                            simhash, token_count, topk, wavelet, whitening)
from thermoflux.sources.tables import read_table

#: Key of the registered pseudonym query and stage; a deployment passes its own secret.
DEMO_KEY = "thermoflux demonstration key"
#: Text of both turns of conversation -7.
CHAT_CONFLICT = r"\### Assistant: </turn> ok"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(common.reachable(spark), sf_dir, "documents")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(_documents(spark, sf_dir))


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_file_digests(_documents(spark, sf_dir))


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel.pseudonym_counts(_documents(spark, sf_dir), DEMO_KEY)


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), shingle=3, bits=3)
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op5_exact_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(read_table(common.reachable(spark), sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return decision_list.apply_rules(docs, decision_list.fit_rules(docs, read_table(spark, sf_dir, "labels")))


def op7_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.pack_tokens(_documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"), count="n_removed", least=1, growing=True)


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.quality_scores(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op10_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_index.coded_digests(_documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` as a long, null where it does not fit one (millions of rows)."""
    found = whitening.whitened(read_table(common.reachable(spark), sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(_documents(spark, sf_dir))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts hold the template's control strings."""
    extra = spark.sql("SELECT -7L AS conv_id, turn, role FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)").withColumn("text", F.lit(CHAT_CONFLICT))
    return chat_format.chat_digests(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_wavelet_tokens, op3_feistel_pseudonyms, op4_simhash_components, op5_exact_top5,
                            op6_decision_list, op7_length_buckets, op8_line_dedup, op9_rule_ensemble, op10_pair_index_bpe, op11_whitening, op12_alignment, op13_chat_format)}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_top5": """
        WITH good AS (
            SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.own, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM good q JOIN good c ON c.own <> q.own AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op13_chat_format": r"""
        WITH source AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
        sized AS (
            SELECT *, len(text) + len(regexp_extract_all(text, '### System:|### User:|### Assistant:|### @|</turn>')) + 10 +
                      CASE WHEN role IN ('system', 'user', 'assistant') THEN 5 + len(role)
                           ELSE 6 + len(role) + 2 * len(regexp_extract_all(role, '[%:#<\n]')) END AS size
            FROM source)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(size) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id""",
}
