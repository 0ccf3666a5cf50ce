"""A corpus pipeline: toxic documents go, repeated lines go, near duplicates go, sources are mixed, texts are encoded.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and works on all
that the one before returned, written as Parquet and read again.  All but the last return
the columns of ``documents``, the mixture also ``mix_pass``; the last returns the token ids of each
document and pass.  The query's columns are digests of those (:func:`run`); :func:`corpus` has the ids.  Rows are told apart by ``doc_id`` and a hash of the text.

Defined results: null and empty texts are never toxic, have no lines, are no copies of each other,
and the mixture takes no words of them, so they are not in the result; rows equal in
``doc_id`` and text are one document from the near-dedup on, which keeps the smallest of its other columns; extra
columns are kept until the last stage, but an own ``mix_pass`` gives way to the mixture's; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, line_dedup, mixing, near_dups, toxicity
from tessera.llm.common import table
from tessera.operators.core import materialize

#: The tokenizer of the last stage.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Hundredths of the words' shingles that near duplicates share.
SIMILARITY = 80


def _matching(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (left_semi) or without (left_anti) their ``doc_id, text_hash`` in ``verdicts``."""
    keys = verdicts.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__of")).distinct()
    own = docs.withColumn("__hash", F.xxhash64("text"))
    return own.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__of")), how)


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` of the text as it is now."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that are rejected as toxic go."""
    flags = toxicity.flag(docs, table(spark, sf_dir, "labels"))
    return _matching(docs, flags.where("predicted = 1"), "left_anti").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: later copies of repeated runs of lines go, and documents that hold nothing else."""
    left = line_dedup.dedup(docs).where("n_lines = 0 or n_deleted < n_lines")
    return _with_length(left, docs.columns)


def drop_near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of near duplicates stays."""
    kept = near_dups.near_dups(docs, SIMILARITY).where("kept")
    order = [f"`{c}`" for c, kind in docs.dtypes if c != "text" and "map<" not in kind and "variant" not in kind]
    one = F.min_by(F.struct(*[f"`{c}`" for c in docs.columns]), F.struct(*order)).alias("__row")
    return _matching(docs, kept, "left_semi").groupBy("doc_id", "__hash").agg(one).select("__row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: sources at their target weights; a row per document and pass, with the words that the pass takes."""
    docs = docs.drop("mix_pass")
    return _with_length(mixing.mixed_texts(docs, "mix_pass"), [*docs.columns, "mix_pass"])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: ``doc_id, mix_pass, n_tokens, ids`` of each row."""
    return bpe.token_ids(docs, TOKENIZER, ["doc_id", "mix_pass"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dups", drop_near_dups),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: No SQL expresses the models, signatures, draws and merges; the tests hold each stage against brute force.
ORACLE_SQL = None


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages but the last over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the token ids of each document and pass."""
    return STAGES[-1][1](spark, mixture(spark, sf_dir), sf_dir)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query ``pipeline``: number of tokens and digests of each row of :func:`corpus`, in the columns of op3_bpe."""
    return bpe.encode(mixture(spark, sf_dir), TOKENIZER)
