"""MinHash near-dedup: banded signatures, links confirmed on full sets, connected components.

1. Each text becomes its set of five-word shingles (64-bit hashes), the set's digest, and a
   signature of ``ROWS`` minima for each band under universal hash functions.
2. Equal sets are one class from here on, so thousands of exact copies cost one row.
3. Classes that agree in a band share a bucket.  Each bucket's center, the class that shares
   most buckets, is compared with its other members: one pair a member, never all pairs.  Groups
   of near copies fall together here.
4. Buckets that still hold several components may hide links between members that are
   not the center.  In buckets of up to ``SMALL`` components, members of different components are
   paired (fewer than ``SMALL`` partners a member).  Larger ones are cut into tiles of two blocks of
   about ``BLOCK`` members; a tile counts the shared shingles of all its members by products
   of incidence matrices and returns links that join components only, no more than it has members.
   So a group of variants that are all just too different costs arithmetic, but no rows.
5. Pairs are dropped by their signatures only where sets as similar as a link would agree so little
   with a probability below 2e-9, and confirmed on the full sets of their whole texts.  Components
   of the confirmed links come from alternating large-star and small-star rounds.

The similarity is a parameter; the number of bands and the bound on agreeing minima follow
from it.  A linked pair shares no band of stage 3 with a probability of at most 8e-7 (24 bands of 5
rows at a similarity of 0.85, 36 at 0.8; less for more similar pairs).

Defined results: a null or empty text or one without words has an empty set, is linked with
nothing and kept; with fewer words than a shingle, the whole text is its one
shingle; rows with equal sets are linked, repeated rows among them, and all rows that
have the component's smallest ``doc_id`` are kept; rows with a null ``doc_id`` are linked
with nothing and kept, without component; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import distinct, map_arrow, release, words_of
from tessera.operators.core import materialize

#: Words of a shingle, and the similarity of links in hundredths: 100 * intersection >= SIMILARITY * union.
SHINGLE, SIMILARITY = 5, 85
#: Minima of a band, and the probability at most that a link shares no band.
ROWS, MISSED = 5, 8e-7
#: Components of the largest bucket whose members are paired, and members of a block of larger ones.
SMALL, BLOCK = 8, 256
_SEED = np.random.Generator(np.random.PCG64(20240607))
_PLACE = _SEED.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


class Plan:
    """Bands, hash functions and the bound on agreeing minima for links of a similarity (in hundredths)."""

    def __init__(self, similarity: int = SIMILARITY):
        if not 0 < similarity < 100:
            raise ValueError("similarity must lie between 0 and 100")
        share = similarity / 100
        self.similarity, self.bands = similarity, math.ceil(math.log(MISSED) / math.log1p(-(share**ROWS)))
        n = self.minima = self.bands * ROWS
        # the mean of the agreeing minima of a link less more than 6.6 standard deviations
        self.agree = max(0, math.floor(n * share - 6.6 * math.sqrt(n * share * (1 - share))))
        seed = np.random.Generator(np.random.PCG64([20240607, similarity]))
        self.a = seed.integers(1, 1 << 63, n, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
        self.b = seed.integers(0, 1 << 63, n, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    starts, codes, words = words_of(texts, lower=True)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()], dtype=np.uint64)
    h = hashes[codes] if len(codes) else np.zeros(0, dtype=np.uint64)
    rolled = np.zeros(len(h), dtype=np.uint64)
    for k in range(SHINGLE):
        rolled[: max(len(h) - k, 0)] += h[k:] * _PLACE[k]
    rolled = _mix(rolled)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= SHINGLE:
            out.append(distinct(rolled[a : b - SHINGLE + 1]))
        elif b > a:  # all words as one shingle; the number of words keeps it apart from longer ones
            out.append(_mix(np.array([(h[a:b] * _PLACE[: b - a]).sum() + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(plan: Plan, shingles: np.ndarray) -> bytes:
    least = np.full(plan.minima, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 512):
        hashed = shingles[None, i : i + 512] * plan.a[:, None]
        hashed += plan.b[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def sign(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = shingle_sets(b.column("text"))
        full = [len(s) > 0 for s in sets]
        columns = [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([blake2b(s.tobytes(), digest_size=16).digest() if f else None for s, f in zip(sets, full)], pa.binary()),
            pa.array([signature(plan, s) if f else None for s, f in zip(sets, full)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), *columns], names=["doc_id", "text_hash", "n_shingles", "node", "sig"])


def confirm(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts whose full sets are similar enough."""
    for b in batches:
        texts = pa.concat_arrays([b.column("text_a").cast(pa.large_string()), b.column("text_b").cast(pa.large_string())]).dictionary_encode()
        sets, code, n = shingle_sets(texts.dictionary), texts.indices.to_numpy(), b.num_rows
        linked = []
        for i, j in zip(code[:n], code[n:]):
            x, y = sets[i], sets[j]
            both = np.concatenate([x, y])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            linked.append(100 * shared >= plan.similarity * (len(both) - shared))
        yield b.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def band_keys(plan: Plan, sig: str) -> Column:
    """Bucket keys of a signature, one per band."""
    numbers = F.array(*[F.lit(k) for k in range(plan.bands)])
    return F.transform(numbers, lambda k: F.xxhash64(k, F.substring(sig, 4 * ROWS * k + 1, 4 * ROWS)))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets, from products of incidence matrices of a few thousand shingles at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1  # shingles that only one set has don't count
    owner, code = owner[times[code] > 1], number[code[times[code] > 1]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, 8192):
        a, b = np.searchsorted(code, [low, low + 8192])
        part = np.zeros((len(sets), 8192), dtype=np.float32)
        part[owner[a:b], code[a:b] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def tile_links(plan: Plan, group: pa.Table) -> pa.Table:
    """Links between members of different components in a tile, one for each two components that fall together."""
    group = group.combine_chunks()
    sets = shingle_sets(group.column("text").chunk(0))
    size = np.array([len(s) for s in sets])
    shared = shared_counts(sets)
    linked = 100 * shared >= plan.similarity * (size[:, None] + size[None, :] - shared)
    nodes, roots = group.column("node").to_pylist(), group.column("root").to_pylist()
    parent: dict[bytes, bytes] = {r: r for r in roots}

    def top(r: bytes) -> bytes:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    found = []
    for i, j in np.argwhere(np.triu(linked, 1)).tolist():
        x, y = top(roots[i]), top(roots[j])
        if x != y:
            parent[x] = y
            found.append((nodes[i], nodes[j]))
    del sets, shared, linked
    release()
    return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: every node of ``edges`` (``a, b``) and its component's smallest node."""
    edges = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        # large star: a node's larger neighbours link to the smallest of it and its neighbours
        ways = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: a node and its smaller neighbours link to the smallest of those
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u != v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == state:
            break
        state = now
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(pairs.select(F.col("root").alias("node"), "root").distinct())


def _confirmed(plan: Plan, pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among candidate ``pairs`` (``a, b``): first by signatures, then by the sets of the texts."""
    sig = classes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), classes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    near = pairs.join(sig[1], "b").join(sig[0], "a").where(_agreeing(plan, "sig_a", "sig_b") >= plan.agree).select("a", "b")
    rows = near.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return map_arrow(rows.select("a", "b", "text_a", "text_b"), partial(confirm, plan), "a binary, b binary")


def _agreeing(plan: Plan, a: str, b: str) -> Column:
    """Number of equal minima of two signatures."""
    # a loop in the plan, not a term for each minimum: the driver compiles and prints every join that holds this condition
    places = F.array(*[F.lit(4 * i + 1) for i in range(plan.minima)])
    return F.aggregate(places, F.lit(0), lambda n, i: n + (F.substring(a, i, 4) == F.substring(b, i, 4)).cast("int"))


def _centered(bands: DataFrame) -> DataFrame:
    """``key, node, center`` of the buckets that have several members."""
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("x"), F.max("node").alias("y")).where("x != y")
    members = materialize(bands.join(buckets.select("key", "members"), "key"), "members")
    shares = members.groupBy("node").agg(F.sum("members").alias("shares"))
    centers = members.join(shares, "node").groupBy("key").agg(F.max(F.struct("shares", "node")).alias("center"))
    return materialize(members.join(centers.select("key", "center.node").withColumnRenamed("node", "center"), "key").drop("members"), "centered")


def _links_in_mixed(plan: Plan, members: DataFrame, stars: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components (``root``) that share a bucket of ``members`` (``key, node, root``)."""
    counts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"))
    mixed = materialize(members.join(counts.where("roots > 1"), "key"), "mixed")
    own = mixed.where(F.col("roots") <= SMALL)
    a, b = (own.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "root")]) for s in "ab")
    pairs = a.join(b, "key").where("root_a < root_b").select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    paired = _confirmed(plan, pairs.join(known, ["a", "b"], "left_anti"), classes, texts)
    large = mixed.where(F.col("roots") > SMALL)
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    block = F.pmod(F.xxhash64("node"), blocks)
    rows = large.select("key", "node", "root", block.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    rows = rows.select("key", "node", "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    tiles = rows.join(texts, "node").groupBy("key", "low", "high")
    return paired.union(tiles.applyInArrow(lambda group: tile_links(plan, group), "a binary, b binary"))


def near_dups(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash`` of every row of ``docs`` (``doc_id, text``); links by ``similarity`` hundredths."""
    plan = Plan(similarity)
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = dict(docs.dtypes)["doc_id"]
    signed = map_arrow(own, partial(sign, plan), f"doc_id {kind}, text_hash long, n_shingles long, node binary, sig binary")
    signed = materialize(signed, "signed")
    named = signed.where("node is not null and doc_id is not null")
    classes = named.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("sig").alias("sig"))
    classes = materialize(classes, "classes")
    bands = classes.select("node", F.explode(band_keys(plan, "sig")).alias("key"))
    members = _centered(bands)
    place = classes.select("node", "first.doc_id", "first.text_hash")
    needed = place.join(members.select("node").distinct(), "node")
    texts = materialize(own.join(needed, ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"]), "texts")
    stars = members.where("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(_confirmed(plan, stars, classes, texts), "links")
    roots = components(links)
    rooted = members.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    links = materialize(links.union(_links_in_mixed(plan, rooted, stars, classes, texts)), "links")
    roots = materialize(components(links), "roots")
    least = roots.join(place, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = place.select("node", F.col("doc_id").alias("own")).join(roots, "node", "left").join(least, "root", "left")
    of_node = of_node.select("node", F.coalesce("component_id", "own").alias("component_id"))
    out = signed.withColumn("node", F.when(F.col("doc_id").isNotNull(), F.col("node"))).join(of_node, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "text_hash")
