"""The registered queries of this subpackage: each runs its operator over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from webloom.llm import (
    chat_format, embeddings, exact_dedup, hard_negatives, language, line_dedup, mixing, pieces, sharding,
    simhash, spelling, token_count, url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(_table(spark, sf_dir, "documents")))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.Model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.round_trips(_table(spark, sf_dir, "documents"), model)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), vocabulary)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    tricky = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    more = spark.createDataFrame(tricky, "conv_id bigint, turn bigint, role string, text string")
    read = chat_format.digest(chat_format.format_chats(chats.unionByName(more)))
    return read.drop("n_attachments", "attachment_tokens")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_token_count": op10_token_count,
    "op11_chat_format": op11_chat_format,
    "op12_spelling": op12_spelling,
    "op13_hard_negatives": op13_hard_negatives,
}
