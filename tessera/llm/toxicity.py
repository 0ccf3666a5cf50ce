"""Toxicity: class-conditional Kneser-Ney models, compared by length-normalised likelihood.

Two models, one of toxic and one of ordinary text, give the probability of each
character of a word after its five predecessors in the word.  Their counts less a
discount back off to one shared lower order, Kneser-Ney's: in how many different
left contexts a character follows its two predecessors, counted over *all*
documents.  Both classes back off to the same numbers, so stems with many rare
endings are known by their stems, and what neither class has seen says little.

A word's two log-likelihoods give its log ratio.  Only what exceeds ``MARGIN`` nats
counts: unusual words of ordinary text reach that by chance.  A document's evidence
is taken over its different words and compared per word; that, and the same times
the root of the number of words, go into a logistic calibration fitted on
labelled rows that gave no class counts.

Counts are Spark tables that grow with the input.  Each different word (in lower case, without
marks at its ends) is one row with the number of documents that hold it, by class; its characters are
counted by their true contexts (``left``, ``low``, ``char``: code points packed into integers, so no two
contexts share a row), and left contexts are counted exactly.  Words are dealt into parts of about
``PART`` characters, whose number grows with the input.  A part is counted by itself, its cells
(each once) are joined with the log ratios, and its words are scored by the cells that come back.
Words with evidence, known by 128-bit digests, are joined to the documents; nothing is broadcast by hint.
No row, context or class is dropped or capped.

Defined results: a null or empty text, or one of white space alone, scores as a
text without evidence; a null ``doc_id`` counts as a row without label and not held
out; null labels are no labels; repeated rows of documents are scored each;
repeated labels of one ``doc_id`` count once each in training and never multiply
the scored rows; without any label of one of the classes every score is 0.5.
Extra columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import distinct, document_of, map_arrow, release, words_of
from tessera.operators.core import materialize

#: Characters of the different words of a part.
PART = 1 << 20
#: Discount of the class counts, and Kneser-Ney's of the lower order.
DISCOUNT, LOW_DISCOUNT = 2.0, 0.75
#: Nats of a word's log ratio that are no evidence yet.
MARGIN = 3.0
#: A document is toxic from this score on.
THRESHOLD = 0.7
#: Labels, and the mark of rows that give no class counts.
ORDINARY, TOXIC, ALL = 0, 1, 2
#: Marks that don't belong to a word at its ends.
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def remainder(doc_id: Column, k: int = 3) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % k


def normal(words: pa.Array) -> pa.Array:
    """Words in lower case, without marks at their ends, with 0 for every digit."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(words), r"[0-9]", "0"), characters=EDGES)


def digests(words: list[str]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(w.encode()) for w in words]


def cells(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each character of the words: the word's number, the three and the two characters before it (packed), and itself.

    Words get five pads before and an end mark (1) after them; code points count from 2.
    """
    n = len(words)
    length = np.array([len(w) for w in words], dtype=np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    ends = np.cumsum(length)
    padded = np.zeros(len(points) + 6 * n, dtype=np.uint32)
    at = np.arange(5, len(points) + 5)
    at += np.repeat(np.arange(0, 6 * n, 6), length)
    padded[at] = points + np.uint32(2)
    del at
    padded[ends + 6 * np.arange(n) + 5] = 1
    at = np.flatnonzero(padded)
    word, char = np.repeat(np.arange(n), length + 1), padded[at].astype(np.int64)
    packed = []
    for places in ((3, 4, 5), (1, 2)):  # in place: a part's arrays are large
        out = np.zeros(len(at), dtype=np.int64)
        for k in places:
            out <<= 21
            out |= padded[at - k]
        packed.append(out)
    return word, *packed, char


def _types(starts: np.ndarray, codes: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different words of each document: document numbers and codes."""
    pairs = distinct(document_of(starts) * n_words + codes)
    return pairs // n_words, pairs % n_words


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words of each batch, with the number of documents of each class that hold them."""
    for b in batches:
        starts, codes, words = words_of(b.column("text"))
        if not len(words):
            continue
        doc, code = _types(starts, codes, len(words))
        channel = b.column("channel").to_numpy(zero_copy_only=False)[doc]
        held = normal(words).dictionary_encode()
        code = held.indices.to_numpy()[code]
        counts = [pa.array(np.bincount(code[channel == k], minlength=len(held.dictionary))) for k in (ORDINARY, TOXIC)]
        yield pa.RecordBatch.from_arrays([held.dictionary.cast(pa.string()), *counts], names=["word", "ordinary", "toxic"])


def _distinct_cells(left: np.ndarray, low: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different cell occurs first (ordered by cell), and the number of every character's cell."""
    near = low << 21 | char
    order = np.lexsort((near, left))
    new = np.append(True, (np.diff(left[order]) != 0) | (np.diff(near[order]) != 0))
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def spell(group: pa.Table) -> pa.Table:
    """Cells of a part's words, with the sums of the words' counts."""
    word, left, low, char = cells(group.column("word").to_pylist())
    first, number = _distinct_cells(left, low, char)
    sums = []
    for c in ("ordinary", "toxic"):
        out = np.zeros(len(first), dtype=np.int64)
        np.add.at(out, number, group.column(c).to_numpy()[word])
        sums.append(out)
    part = np.full(len(first), group.column("part")[0].as_py(), dtype=np.int64)
    out = pa.table([pa.array(x) for x in (part, left[first], low[first], char[first], *sums)], names=["part", "left", "low", "char", "ordinary", "toxic"])
    del word, left, low, char, first, number, sums, part
    release()
    return out


def weigh(group: pa.Table, ratios: pa.Table) -> pa.Table:
    """Digests and evidence of a part's words that have any, by the log ratios of the part's cells."""
    words = group.column("word").to_pylist()
    word, left, low, char = cells(words)
    first, number = _distinct_cells(left, low, char)
    a, b, c = (ratios.column(x).to_numpy() for x in ("left", "low", "char"))
    if len(first) != len(a):
        raise ValueError("the cells of a part are not those of its words")
    order = np.lexsort((b << 21 | c, a))
    sums = np.bincount(word, weights=ratios.column("ratio").to_numpy()[order][number], minlength=len(words))
    at = np.flatnonzero(sums > MARGIN)
    del word, left, low, char, first, number, a, b, c, order
    release()
    return pa.table([pa.array(digests([words[i] for i in at.tolist()]), pa.binary()), pa.array(sums[at] - MARGIN)], names=["word", "evidence"])


def _discounted(count: Column, n: Column, freed: Column, backoff: Column, discount: float) -> Column:
    """Counts less a discount, whose mass goes to ``backoff``; a context without counts leaves all to it."""
    return F.when(n > 0, (F.greatest(count - discount, F.lit(0.0)) + freed * backoff) / n).otherwise(backoff)


def log_ratios(spelled: DataFrame) -> DataFrame:
    """``left, low, char, ratio``: log p(char | context, toxic) - log p(char | context, ordinary) of all that occur."""
    names = ("ordinary", "toxic")
    counts = materialize(spelled.groupBy("left", "low", "char").agg(*[F.sum(c).alias(c) for c in names]), "cells")
    follows = materialize(counts.groupBy("low", "char").agg(F.count(F.lit(1)).alias("follows")), "follows")  # left contexts of (low, char)
    alone = follows.groupBy("char").agg((F.sum("follows") + 0.5).alias("alone"))
    total = alone.agg(F.sum("alone")).first()[0]
    sums = follows.groupBy("low").agg(F.sum("follows").alias("n"), F.sum(F.least("follows", F.lit(LOW_DISCOUNT))).alias("freed"))
    lower = _discounted(F.col("follows"), F.col("n"), F.col("freed"), F.col("alone") / F.lit(total), LOW_DISCOUNT)
    lower = follows.join(sums, "low").join(alone, "char").select("low", "char", lower.alias("lower"))
    mass = [F.sum(c).alias(f"{c}_n") for c in names] + [F.sum(F.least(c, F.lit(DISCOUNT))).alias(f"{c}_freed") for c in names]
    contexts = counts.groupBy("left", "low").agg(*mass)
    ordinary, toxic = (F.log(_discounted(F.col(c), F.col(f"{c}_n"), F.col(f"{c}_freed"), F.col("lower"), DISCOUNT)) for c in names)
    return counts.join(contexts, ["left", "low"]).join(lower, ["low", "char"]).select("left", "low", "char", (toxic - ordinary).alias("ratio"))


def word_evidence(words: DataFrame) -> DataFrame:
    """``word, evidence`` (digest, nats beyond the margin) of the ``words`` (``word, ordinary, toxic``) that have any."""
    size = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    words = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(size // PART + 1)))
    spelled = words.groupBy("part").applyInArrow(spell, "part long, left long, low long, char long, ordinary long, toxic long")
    spelled = materialize(spelled, "spelled")
    ratios = spelled.select("part", "left", "low", "char").join(log_ratios(spelled), ["left", "low", "char"])
    own = words.select("part", "word").groupBy("part").cogroup(ratios.groupBy("part"))
    return materialize(own.applyInArrow(weigh, "word binary, evidence double"), "evidence")


def words_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document a row per word (``times`` if several words are that one without marks), and one that is no word."""
    for b in batches:
        starts, codes, words = words_of(b.column("text"))
        hashes = b.column("text_hash").to_pylist()
        marks = pa.array([h.to_bytes(8, "little", signed=True) for h in hashes], pa.binary())
        doc, key, times, n = np.arange(len(hashes)), marks, np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        if len(words):
            d, code = _types(starts, codes, len(words))
            n = np.bincount(d, minlength=len(n))
            held = normal(words).dictionary_encode()
            pairs, of = np.unique(d * len(held.dictionary) + held.indices.to_numpy()[code], return_counts=True)
            d, code = pairs // len(held.dictionary), pairs % len(held.dictionary)
            own = pa.array(digests(held.dictionary.to_pylist()), pa.binary()).take(pa.array(code))
            doc, key, times = np.append(doc, d), pa.concat_arrays([marks, own]), np.append(times, of)
        order = np.argsort(doc, kind="stable")  # rows of a document together, for the sums before the shuffle
        at = pa.array(doc[order])
        for i in range(0, len(order), 1 << 16):
            part, own = pa.array(order[i : i + (1 << 16)]), at[i : i + (1 << 16)]
            columns = [b.column("doc_id").take(own), b.column("text_hash").take(own), key.take(part), pa.array(times).take(part), pa.array(n).take(own)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "word", "times", "n"])


def features(docs: DataFrame, evidence: DataFrame) -> DataFrame:
    """``doc_id, text_hash, per_word, scaled`` of every row of ``docs``."""
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    held = map_arrow(own, words_held, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash long, word binary, times long, n long")
    held = held.join(evidence, "word", "left").groupBy("doc_id", "text_hash")
    # repeated rows fall together: their number is that of the rows that are no words
    sums = held.agg(F.sum((F.col("times") == 0).cast("int")).alias("rows"), F.max("n").alias("n"), F.sum(F.col("times") * F.col("evidence")).alias("total"))
    sums = sums.withColumn("per_word", F.coalesce(F.col("total") / F.col("rows") / F.col("n"), F.lit(0.0)))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    return sums.select("doc_id", "text_hash", "per_word", (F.col("per_word") * F.sqrt("n")).alias("scaled"), each.alias("row")).drop("row")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, text_hash`` of every row of ``docs``.

    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id, toxic``.  Labels are read
    only where crc32 of ``doc_id`` leaves a remainder other than 1 by 3; of those,
    the rows with remainder 3, 6 or 8 by 12 calibrate and the others count.
    """
    part = remainder(F.col("doc_id"), 12)
    marked = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("channel")).where(part % 3 != 1)
    counted = ~part.isin(3, 6, 8)
    # labels have no bound, so they are never broadcast, at any size
    trained = docs.where((part % 3 != 1) & counted).select("doc_id", "text").join(marked.where(counted).hint("merge"), "doc_id")
    every = docs.select("text", F.lit(ALL).alias("channel"))
    words = map_arrow(every.unionByName(trained.select("text", "channel")), count_words, "word string, ordinary long, toxic long")
    words = materialize(words.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "words")
    both = all(words.agg(F.max("ordinary"), F.max("toxic")).first())
    feats = materialize(features(docs, word_evidence(words)), "toxicity")
    feats = feats.withColumn("held_out", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)))
    if not both:
        return feats.select("doc_id", "held_out", F.lit(0.5).alias("score"), "text_hash")
    sample = feats.join(marked.where(~counted), "doc_id")
    if sample.select("channel").distinct().count() < 2:  # too few rows to set some apart
        sample = feats.join(marked, "doc_id")
    vectors = VectorAssembler(inputCols=["per_word", "scaled"], outputCol="features")
    fit = LogisticRegression(labelCol="channel", regParam=1e-4, maxIter=50).fit(
        vectors.transform(sample.select("channel", "per_word", "scaled"))
    )
    a, (b, c) = float(fit.intercept), (float(x) for x in fit.coefficients)
    z = F.lit(a) + F.lit(b) * F.col("per_word") + F.lit(c) * F.col("scaled")
    return feats.select("doc_id", "held_out", (1 / (1 + F.exp(-z))).alias("score"), "text_hash")


def flag(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """:func:`score` with the verdict ``predicted`` (1: toxic)."""
    return score(docs, labels).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
