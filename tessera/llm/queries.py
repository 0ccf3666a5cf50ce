"""Queries of the operators of this subpackage, one each, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from tessera.llm import bpe, license_scan, line_dedup, mixing, near_dups, part_codes, phrases, pii, quality, secret_scan, token_store, topk, toxicity
from tessera.llm.common import table
from tessera.llm.oracles import ORACLES  # noqa: F401
from tessera.operators.core import materialize



def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), corpus_pipeline.TOKENIZER)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    rate = F.floor(F.col("host_rate") * 1e6 + 0.5) / 1e6  # six digits: the last ones depend on the order of sums
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", rate.alias("host_rate"))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_dups(table(spark, sf_dir, "documents"), similarity=85).drop("text_hash")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_store.write_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_documents(materialize(blocks, "token-blocks"))


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes.codes(table(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_licenses, op2_top_k, op3_bpe, op4_mixing, op5_toxicity, op6_quality, op7_near_dups, op8_pii, op9_secrets, op10_line_dedup,
        op11_repair, op12_part_codes, op13_phrases,
    )
} | {"pipeline": corpus_pipeline.run}
