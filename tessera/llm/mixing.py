"""Mixing sources to target weights: a mixture of fixed-length blocks of words.

1. The words of a source's documents, one after the other (by ``doc_id``, then a hash of
   the text), are cut into blocks of ``BLOCK`` words.  Places come from range-partitioned
   running sums, so a source may hold any part of all rows.
2. Sources get targets by weight; none above ``MOST`` times its size, the excess goes to the others.
3. The mixture is a row of output shards of ``SLOTS`` slots, a block each.  A shard draws its
   sources as a stratified multinomial: slot i takes the source under (i + u) / SLOTS of the
   cumulative targets, u a hash in [0, 1) of shard and slot.  Every slot is an own draw, and a
   source's count over all shards stays within a few slots of its share.
4. The j-th slot of a source takes block P(j mod n) of its n blocks, P a pseudorandom
   permutation (swap-or-not, for any n) drawn anew for each pass.  A source is never passed more than
   ``MOST`` times, so no block, and no document, is taken more often.
5. Blocks and slots meet by index, and a document's share is what its blocks were taken.

Draws and permutations are hashes of numbers, so reruns agree.  Everything is done by
DataFrame functions.

Defined results: a null or empty text has size 0 and is never taken; a null source is the last
source; rows of equal ``doc_id`` and text have places of their own and are told apart by them; a
null ``doc_id`` comes first; without any word all targets are 0; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.core import materialize, ordered_index, running_totals

#: Words of a block, slots of an output shard.
BLOCK, SLOTS = 64, 4096
#: Weights of the sources in their order, repeating; words of the mixture and of a source at most, as multiples of the input's.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Rounds of the permutation; number that all draws depend on.
ROUNDS, SEED = 12, 4
_GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, _GAP), "")


def _uniform(*parts: Column) -> Column:
    """Number in [0, 1) that depends on the parts."""
    return F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 52)) / float(1 << 52)


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Place of ``x`` under a pseudorandom permutation of 0 .. n - 1 named by ``key``: swap or not with its partner in each round."""

    def swap(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *key), n) - at, n)
        return F.when(F.xxhash64(F.lit(SEED + 1), r, *key, F.greatest(at, partner)) % 2 == 0, partner).otherwise(at)

    return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), x, swap)


def targets(sizes: DataFrame) -> DataFrame:
    """``source, number, source_size, target`` from ``source, source_size``: weighted shares, none above ``MOST`` sizes."""
    known = F.when(F.col("source").isNull(), 1).otherwise(0)
    sources = ordered_index(sizes, [known, "source"], name="number")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("number") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")).cast("double")
    sources = materialize(sources.withColumn("weight", weight), "sources")
    most = F.col("source_size") * float(MOST)
    level = 0.0  # words for each unit of weight; rises until no further source is above its limit
    while True:
        full = F.col("weight") * level > most
        at = sources.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if not at["all"] or not at["open"]:
            break
        higher = (SHARE * at["all"] - at["fixed"]) / at["open"]
        if higher <= level * (1 + 1e-15):
            break
        level = higher
    return sources.select("source", "number", "source_size", F.least(F.col("weight") * level, most).alias("target"))


@dataclass
class Mix:
    """``docs``: a row per row of the input, ``place`` tells rows of a source apart; ``pieces``: the parts of documents in taken blocks;
    ``slots``: the mixture, ``shard, number, pass, block``."""

    docs: DataFrame
    pieces: DataFrame
    slots: DataFrame


def draw(sources: DataFrame) -> DataFrame:
    """``shard, number, pass, block``: every slot of the mixture."""
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("long")
    # blocks are BLOCK words but for each source's last, hence slots by the mean size of its blocks
    own = sources.where("source_size > 0").select("number", blocks.alias("blocks"), (blocks * F.col("target") / F.col("source_size")).alias("share"))
    own = running_totals(own, ["number"], [], ["share"], prefix="up_to_")
    own = materialize(own, "shares")
    total = own.agg(F.sum("share")).first()[0] or 0.0
    shards = max(1, round(total / SLOTS))
    slots = max(1, math.ceil(total / shards))  # of a shard
    low, high = (F.col("up_to_share") - F.col("share")) / shards, F.col("up_to_share") / shards
    at = own.select("number", "blocks", low.alias("low"), high.alias("high"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    first, last = F.floor("low"), F.floor("high")
    u = lambda i: i + _uniform(F.lit("slot"), F.col("shard"), i)
    one = ((u(first) >= F.col("low")) & (u(first) < F.col("high"))).cast("long")
    more = (last - first - 1) + (u(first) >= F.col("low")).cast("long") + (u(last) < F.col("high")).cast("long")
    counts = at.select("number", "blocks", "shard", F.when(first == last, one).otherwise(more).alias("n")).where("n > 0")
    counts = running_totals(counts, ["shard"], ["number"], ["n"], prefix="up_to_", many_groups=True)
    # few rows make many slots: deal them out before that
    parts = max(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / 250_000))
    counts = counts.repartition(parts, "number", "shard")
    j = F.explode(F.sequence(F.col("up_to_n") - F.col("n"), F.col("up_to_n") - 1)).alias("j")
    drawn = counts.select("shard", "number", "blocks", j).where(F.col("j") < MOST * F.col("blocks"))
    turn = F.floor(F.col("j") / F.col("blocks")).cast("long")
    drawn = drawn.select("shard", "number", "blocks", turn.alias("pass"), F.pmod("j", "blocks").alias("x"))
    block = permuted(F.col("x"), F.col("blocks"), F.col("number"), F.col("pass"))
    return drawn.select("shard", "number", "pass", block.alias("block")).repartition("number", "block")


def mix(docs: DataFrame) -> Mix:
    """Mix the rows of ``docs`` (``doc_id, text, source``)."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("size"))
    rows = rows.withColumn("size", F.greatest("size", F.lit(0).cast("long")))
    rows = materialize(running_totals(rows, ["doc_id", "text_hash", "size"], ["source"], ["size"], prefix="up_to_", many_groups=True), "sizes")
    sources = materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    s = sources.withColumnRenamed("source", "s")
    rows = rows.join(s, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("place", F.col("up_to_size") - F.col("size")).drop("up_to_size")
    slots = draw(sources)
    taken = slots.groupBy("number", "block").agg(F.sort_array(F.collect_list("pass")).alias("passes"))  # MOST at most
    end = F.col("place") + F.col("size")
    parts = rows.where("size > 0").select(
        "doc_id", "text_hash", "number", "place", "size", F.explode(F.sequence(F.floor(F.col("place") / BLOCK), F.floor((end - 1) / BLOCK))).alias("block")
    )
    pieces = parts.join(taken, ["number", "block"]).select(
        "doc_id", "text_hash", "number", "place", "size",
        F.greatest(F.col("block") * BLOCK - F.col("place"), F.lit(0)).alias("from"),
        F.least((F.col("block") + 1) * BLOCK - F.col("place"), F.col("size")).alias("to"),
        "passes",
    )
    return Mix(rows, pieces, slots)


def taken_words(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs``."""
    m = mix(docs)
    taken = m.pieces.groupBy(F.col("number").alias("n"), F.col("place").alias("p")).agg(F.sum((F.col("to") - F.col("from")) * F.size("passes")).alias("taken"))
    out = m.docs.join(taken, (F.col("number") == F.col("n")) & (F.col("place") == F.col("p")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, number: str | None = None) -> DataFrame:
    """The mixture as documents: for each document and pass a row with the words taken in it, other columns as they were.

    With ``number``, a column of that name tells a document's passes apart.  A document
    of which a pass takes every word keeps its text as it is.  Rows of
    equal ``doc_id`` and text get the pieces of each of them.
    """
    per_pass = mix(docs).pieces.select("doc_id", "text_hash", "place", "size", "from", "to", F.explode("passes").alias("pass"))
    # spans are sorted and only begin anew where a block was left out
    spans = per_pass.groupBy("doc_id", "text_hash", "place", "size", "pass").agg(
        F.sum(F.col("to") - F.col("from")).alias("own"), F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans")
    )
    spans = spans.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h"), F.col("own").alias("__own"), F.col("spans").alias("__spans"), F.col("pass").alias("__pass"))
    once = docs.withColumn("__hash", F.xxhash64("text")).dropDuplicates(["doc_id", "__hash"])
    rows = once.join(spans, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__hash") == F.col("__h"))).withColumn("__words", words(F.col("text")))
    cut = F.flatten(F.transform("__spans", lambda s: F.slice("__words", (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int"))))
    text = F.when(F.size("__words") == F.col("__own"), F.col("text")).otherwise(F.array_join(cut, " "))
    passes = [F.col("__pass").alias(number)] if number else []
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], *passes)
