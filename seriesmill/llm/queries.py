"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, exact_dedup, html_extract, mixing, piece_codec, quality_classifier, quality_rules, shuffle_shards, simhash, sql, token_counts, token_store, turn_repair, whitening
from .common import read, staged


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(read(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, sf_dir, "documents"), staged=partial(staged, name="measures"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame(pa.table({"conv_id": [-1, -1], "turn": [0, 1], "role": ["user", "assistant"], "text": [said, said]}))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat_format.round_trip_digests(rows, tokenizer("byte_bpe_50k.json"))


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip_digests(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.predictions(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_shards.report(read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.report(turn_repair.damage(read(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_exact_dedup, op3_html_extract, op4_quality_rules, op5_chat_format, op6_piece_codec, op7_quality_classifier, op8_token_store, op9_mixing, op10_simhash, op11_sharding, op12_whitening, op13_turn_repair)}
ORACLE_SQL = {"op2_exact_dedup": sql.EXACT_DEDUP, "op4_quality_rules": sql.QUALITY_RULES, "op9_mixing": sql.MIXING, "op13_turn_repair": sql.TURN_REPAIR}
