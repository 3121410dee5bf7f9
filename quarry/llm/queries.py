"""Registered queries of the numbered operators (thin) and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    apportion,
    bm25_packing,
    combo_join,
    crf_quality,
    gru_lm,
    kn_toxicity,
    oracles,
    prefix_tokens,
    rmq_search,
    skiplist_fim,
    tput_topk,
    vector_shards,
    warc_chunks,
    word_bpe,
)
from quarry.llm.common import doc_crc, read_docs


def held_out(id_col: str, n: int, rest: int) -> Column:
    """Whether CRC-32 of the id as text leaves ``rest`` modulo ``n``."""
    return F.pmod(doc_crc(id_col), F.lit(n)) == F.lit(rest)


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = crf_quality.trained_quality_rules(read_docs(spark, sf_dir), read_docs(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "content_share")


def op2_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = apportion.sainte_lague_mix(read_docs(spark, sf_dir))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op3_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_shards.vector_shards(read_docs(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op4_combo_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combo_join.jaccard_components(read_docs(spark, sf_dir), width=3, percent=90)


def op5_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.token_counts(read_docs(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op6_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.lm_scores(read_docs(spark, sf_dir), ~held_out("doc_id", 7, 2))


def op7_kn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read_docs(spark, sf_dir), held_out("doc_id", 5, 0)
    judge = kn_toxicity.fit_judge(docs, read_docs(spark, sf_dir, "labels"), ~out)
    return kn_toxicity.toxicity(docs, judge).select("doc_id", out.alias("held_out"), "score", "predicted")


def op8_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chunks.warc_round_trip(read_docs(spark, sf_dir, "pages"))


def op9_tput_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tput_topk.top_k(read_docs(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = word_bpe.encode_documents(read_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_skiplist_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skiplist_fim.fill_in_middle(read_docs(spark, sf_dir), with_output=False)


def op12_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_packing.pack_documents(read_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op13_rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rmq_search.ranked_search(read_docs(spark, sf_dir), read_docs(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_crf_quality, op2_sainte_lague_mix, op3_vector_shards, op4_combo_jaccard, op5_prefix_tokens, op6_gru_lm, op7_kn_toxicity, op8_warc_chunks,
    op9_tput_topk, op10_word_bpe, op11_skiplist_fim, op12_bm25_packing, op13_rmq_search)}
ORACLES = {"op2_sainte_lague_mix": oracles.MIX, "op4_combo_jaccard": oracles.JACCARD, "op8_warc_chunks": oracles.WARC,
           "op9_tput_topk": oracles.TOP, "op11_skiplist_fim": oracles.FIM, "op13_rmq_search": oracles.SEARCH}
