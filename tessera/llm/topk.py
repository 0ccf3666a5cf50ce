"""Exact top-k search by tiled matrix products.

Vectors are packed into shards and queries into blocks, each a row that holds a
matrix.  A tile is one query block against one shard: a matrix product and, for every
query of the block, the tile's own best k.  The lists of a query are then merged as a
tree: ``FAN`` shards at a time, k rows of each, until one list is left, so no task ever
sees more than ``FAN * k`` rows of a query.

The number of tiles is that of query blocks times that of shards; a tile needs the two
matrices and the product, a few MB whatever the input.  Products are exact: in
float64 while every partial sum is an integer below 2**53, else in Python integers.

Defined results: vectors that are null, or hold null or non-finite components, take no
part (nor those whose components leave the doubles when scaled), nor do rows with a null id; vectors of different lengths are not compared; rows with equal id are
one vector, the smallest; ties go to the smaller id; a score beyond 64 bits counts as the nearest
number within them; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow
from tessera.operators.core import materialize

#: Rows of a shard and of a query block, and shards whose lists are merged at a time.
SHARD, BLOCK, FAN = 4096, 1024, 64
#: Components are multiplied by this and rounded down.
SCALE = 256


def _pack(rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs of up to ``rows`` vectors of one length: row of a matrix each, ids beside it."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def full(dim: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, data = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(ids, kind="stable")
        row = [dim], [ids[order].tobytes()], [data[order].tobytes()]
        return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.binary()), pa.array(row[2], pa.binary())], names=["dim", "ids", "data"])

    for b in batches:
        ids, lists = b.column("vec_id").to_numpy(zero_copy_only=False), b.column("v")
        values, at = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        at = at - at[0]
        dims = np.diff(at)
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            data = values[at[own][:, None] + np.arange(dim)[None, :]].reshape(len(own), dim)
            parts = held.setdefault(dim, [])
            parts.append((ids[own], data))
            while sum(len(p[0]) for p in parts) >= rows:
                ids_, data_ = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                yield full(dim, [(ids_[:rows], data_[:rows])])
                parts[:] = [(ids_[rows:], data_[rows:])]
    for dim, parts in held.items():
        if sum(len(p[0]) for p in parts):
            yield full(dim, parts)


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``q`` and ``v`` (float64 holding integers)."""
    with np.errstate(over="ignore"):
        largest = max(np.abs(q).max(initial=0), 1.0) * max(np.abs(v).max(initial=0), 1.0) * q.shape[1]
    if largest < 2**53:
        return (q @ v.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], dtype=object) @ np.array([[int(x) for x in r] for r in v], dtype=object).T
    return np.array([[min(max(x, -(2**63)), 2**63 - 1) for x in r] for r in exact], dtype=np.int64).reshape(exact.shape)


def tile_best(score: np.ndarray, q_ids: np.ndarray, v_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query, the places of its best k in a tile: by score, then by smaller id (``v_ids`` ascend)."""
    for row, own in zip(score, q_ids):
        allowed = np.flatnonzero(v_ids != own)
        if len(allowed) > k:
            row_ = row[allowed]
            least = np.partition(row_, len(row_) - k)[len(row_) - k]
            allowed = allowed[row_ >= least]  # with all ties of the last place
        yield own, allowed[np.argsort(~row[allowed], kind="stable")][:k]  # ~ turns the order round without overflow


def _tiles(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            q_ids, v_ids = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
            q, v = np.frombuffer(r["q_data"], np.float64).reshape(-1, r["dim"]), np.frombuffer(r["data"], np.float64).reshape(-1, r["dim"])
            score = _product(q, v)
            found = [(own, at) for own, at in tile_best(score, q_ids, v_ids, k)]
            queries = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
            ids = np.concatenate([v_ids[at] for _, at in found]).astype(np.int64)
            scores = [int(score[i][j]) for i, (_, at) in enumerate(found) for j in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries), pa.array(ids), pa.array(scores, pa.int64()), pa.array(np.full(len(ids), r["shard"], np.int64))],
                names=["query_id", "vec_id", "score", "shard"],
            )


def merge(lists: DataFrame, n_shards: int, k: int) -> DataFrame:
    """Tree merge of per-shard lists (``query_id, vec_id, score, shard``) into each query's best k, with ``rank``."""
    best = [F.col("score").desc(), F.col("vec_id").asc()]
    while True:
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN).cast("long"))
        n_shards = -(-n_shards // FAN)
        ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "shard").orderBy(*best)))
        lists = ranked.where(F.col("rank") <= k)
        if n_shards <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")


def quantized(vector: Column, scale: int = SCALE) -> Column:
    whole = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)  # noqa: E731  (a long would saturate)
    return F.transform(vector, lambda x: whole(x.cast("double") * scale))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k other rows of greatest inner product.

    ``vectors`` has ``vec_id, embedding``; the rows where ``is_query`` holds are the queries.
    """
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf"))
    )
    clean = vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    clean = clean.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    rows = clean.select("vec_id", quantized(F.col("embedding"), scale).alias("v"))
    schema = "dim int, ids binary, data binary"
    # as many partitions as packs: a small partition would make a small pack, and more tiles than needed
    n_rows, n_asked = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    packed = map_arrow(rows.repartition(max(1, -(-n_rows // SHARD))), lambda it: _pack(SHARD, it), schema)
    shards = materialize(packed.withColumn("mark", F.monotonically_increasing_id()), "shards")
    asked = map_arrow(rows.where(is_query).repartition(max(1, -(-n_asked // BLOCK))), lambda it: _pack(BLOCK, it), schema)
    asked = materialize(asked.withColumn("mark", F.monotonically_increasing_id()), "queries")
    shards, asked = (_numbered(t, name) for t, name in ((shards, "shard"), (asked, "block")))
    n_shards, n_blocks = shards.count(), asked.count()
    if not n_shards or not n_blocks:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where(F.lit(False))
    # one row per tile, then its two matrices by equi-joins
    tiles = rows.sparkSession.range(n_shards * n_blocks).select(
        (F.col("id") % n_shards).alias("shard"), F.floor(F.col("id") / n_shards).cast("long").alias("block")
    )
    parts = max(1, min(n_shards * n_blocks, 1 << 20))
    q = asked.select("block", F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    work = tiles.join(shards, "shard").join(q, "block").where("dim = q_dim").drop("q_dim").repartition(parts, "shard", "block")
    work.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    return merge(work.mapInArrow(lambda it: _tiles(k, it), "query_id long, vec_id long, score long, shard long"), n_shards, k)


def _numbered(packs: DataFrame, name: str) -> DataFrame:
    """Consecutive numbers from 0 in the order of ``mark`` (a window over ids of packs only, each of thousands of vectors)."""
    numbers = packs.select("mark").withColumn(name, F.row_number().over(Window.orderBy("mark")).cast("long") - 1)
    return packs.join(numbers, "mark").drop("mark")
