"""Vector code compression: each vector becomes one small code per part, by tries over the different parts.

Components are scaled and rounded down, vectors cut into ``PARTS`` consecutive parts, and
each part position has a codebook of ``ENTRIES`` entries, begun from the vectors of smallest ids and
refined ``ROUNDS`` times by the means (rounded down) of the parts assigned to them.

Assignment sorts the different parts of a batch of vectors into a lexicographic trie.  A depth-first
traversal carries, for a slice of nodes of one depth, the squared distances to every entry
accumulated over the components so far; children add their own component's, so a common
prefix is computed once, and a leaf takes the smallest distance (the lower entry on ties) and
adds its component sums weighted by how often the part occurs.  A stack of slices bounds the memory
whatever the fan-out.  Arithmetic is exact: 64-bit integers while no sum can pass them, else Python integers.

Vectors are never shuffled or joined to codes: the codebooks (``PARTS * ENTRIES`` entries) go with the
tasks, and sums come back as digits per part, entry and component.

Defined results: vectors that are null or hold null or non-finite components take no part; those
whose length isn't that of the smallest id's vector take none either; a length that 16 doesn't divide
gives parts that differ by one component; fewer vectors than entries give smaller
codebooks; rows of equal id are ordered by their vectors, null ids come last; an error beyond 64 bits is null, and so is
the sum of a label that holds one or passes them; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.core import lookup, materialize

#: Parts of a vector, entries of a codebook, rounds of refinement, and the factor of components.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors whose parts make one set of tries, and nodes of a slice of the traversal.
VECTORS, NODES = 20_000, 2_048
#: Sums travel as digits of this many bits, which any number of tasks can add up in 64.
DIGIT = 32


def usable(vector: Column, scale: int = SCALE) -> Column:
    """Neither null nor with null or non-finite components (scaled, in doubles)."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))


def cuts(dim: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return [k * dim // parts for k in range(parts + 1)]


def _integers(values: np.ndarray, small: bool) -> np.ndarray:
    """Whole numbers as 64-bit integers, or as Python's."""
    if small:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()] + [None], dtype=object)[:-1].reshape(values.shape)


def _small(values: np.ndarray, books: list[np.ndarray]) -> bool:
    """Whether no squared distance and no weighted sum of a batch can pass 64 bits."""
    largest = np.float64(max([np.abs(values).max(initial=0)] + [float(max(map(abs, b.ravel()))) for b in books if b.size]))
    with np.errstate(over="ignore"):
        return bool(max(4 * largest * largest * max(values.shape[1], 1), largest * len(values)) < 2**62)


def traverse(parts: np.ndarray, codebook: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``leaves, entries, distances`` for slices of the leaves of a trie.

    ``parts``: different rows in lexicographic order; ``codebook``: one row an entry.
    """
    n, depth = parts.shape
    if not n:
        return
    # begins[j]: the rows at which a prefix of j components is new, and the end; nodes of depth j are places in it
    new = np.arange(n) == 0
    begins = [np.array([0, n])]
    for j in range(depth):
        new[1:] |= parts[1:, j] != parts[:-1, j]
        begins.append(np.append(np.flatnonzero(new), n))
    # a slice of nodes: its depth, its first and last node, and the first node and distances of its parents' slice
    stack = [(0, 0, 1, 0, np.zeros((1, len(codebook)), dtype=parts.dtype))]
    while stack:
        j, a, z, above, distance = stack.pop()
        if j:
            rows = begins[j][a:z]
            gap = parts[rows, j - 1][:, None] - codebook[:, j - 1][None, :]
            distance = distance[np.searchsorted(begins[j - 1], rows, "right") - 1 - above] + gap * gap
        if j == depth:
            best = np.argmin(distance, axis=1)
            yield np.arange(a, z), best, distance[np.arange(z - a), best]
            continue
        lo, hi = np.searchsorted(begins[j + 1], begins[j][[a, z]]).tolist()
        for q in reversed(range(lo, hi, NODES)):  # the first children come next
            stack.append((j + 1, q, min(q + NODES, hi), a, distance))


def assign(rows: np.ndarray, codebook: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``entries, distances`` of every row, and the sums of rows by entry (the last column counts them).

    ``small``: 64 bits hold every distance and sum, see :func:`_small`.
    """
    order = np.lexsort(rows.T[::-1]) if rows.shape[1] else np.arange(len(rows))
    in_order = rows[order]
    new = np.arange(len(rows)) == 0
    new[1:] |= (in_order[1:] != in_order[:-1]).any(axis=1)
    leaf_of = np.empty(len(rows), dtype=np.int64)
    leaf_of[order] = np.cumsum(new) - 1
    leaves, book = _integers(in_order[new], small), _integers(codebook, small)
    weight = np.bincount(leaf_of, minlength=len(leaves)).astype(leaves.dtype)
    entry, distance = np.zeros(len(leaves), dtype=np.int64), np.zeros(len(leaves), dtype=leaves.dtype)
    sums = np.zeros((len(book), rows.shape[1] + 1), dtype=leaves.dtype)
    for at, best, least in traverse(leaves, book):
        entry[at], distance[at] = best, least
        np.add.at(sums, best, np.column_stack([leaves[at] * weight[at][:, None], weight[at]]))
    return entry[leaf_of], distance[leaf_of], sums.astype(object)


def _vectors(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, VECTORS):
            b = batch.slice(a, VECTORS)
            yield b, b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)


def _sums(batches: Iterator[pa.RecordBatch], dim: int, books: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """Digits of the component sums and counts of this task: ``part, entry, item, digit, value``."""
    at = cuts(dim, parts)
    total = [np.zeros((len(book), book.shape[1] + 1), dtype=object) for book in books]
    for _, values in _vectors(batches, dim):
        small = _small(values, books)
        for p, book in enumerate(books):
            total[p] += assign(values[:, at[p] : at[p + 1]], book, small)[2]
    rows = []
    for p, t in enumerate(total):
        for (e, i), x in np.ndenumerate(t):
            sign, x, d = (-1, -x, 0) if x < 0 else (1, x, 0)
            while x:
                rows.append((p, e, i, d, sign * (x & ((1 << DIGIT) - 1))))
                x, d = x >> DIGIT, d + 1
    columns = list(zip(*rows)) if rows else [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == 4 else pa.int32()) for k, c in enumerate(columns)], names=["part", "entry", "item", "digit", "value"])


def _codes(batches: Iterator[pa.RecordBatch], dim: int, books: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    at = cuts(dim, parts)
    for b, values in _vectors(batches, dim):
        small = _small(values, books)
        code, error = np.zeros((b.num_rows, parts), dtype=np.uint8), np.zeros(b.num_rows, dtype=object)
        for p, book in enumerate(books):
            entry, distance, _ = assign(values[:, at[p] : at[p + 1]], book, small)
            code[:, p] = entry
            error = error + distance.astype(object)
        texts = code.tobytes().hex()
        errors = [int(x) if x < 2**63 else None for x in error]
        yield pa.RecordBatch.from_arrays(
            [b.column("vec_id"), b.column("label"), pa.array([texts[2 * parts * k : 2 * parts * (k + 1)] for k in range(b.num_rows)], pa.string()), pa.array(errors, pa.int64())],
            names=["vec_id", "label", "code", "error"],
        )


def fit(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks (Python integers, a row an entry) of vectors ``v`` (whole numbers in doubles, ``dim`` each)."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # the first entries, a parameter's number
    begun = np.array([[int(x) for x in r.v] for r in first], dtype=object).reshape(len(first), dim)
    at = cuts(dim, parts)
    books = [begun[:, at[p] : at[p + 1]] for p in range(parts)]
    for _ in range(rounds):
        digits = rows.select("v").mapInArrow(
            lambda it, books=books: _sums(it, dim, books, parts), "part int, entry int, item int, digit int, value long"
        )
        total: dict[tuple[int, int, int], int] = {}
        # at most parts * entries * (components + 1) sums, in some digits each
        for r in digits.groupBy("part", "entry", "item", "digit").agg(F.sum("value").alias("value")).collect():
            total[r.part, r.entry, r.item] = total.get((r.part, r.entry, r.item), 0) + (r.value << DIGIT * r.digit)
        books = [b.copy() for b in books]
        for p, book in enumerate(books):
            count = book.shape[1]
            for e in range(len(book)):
                n = total.get((p, e, count), 0)
                if n:
                    book[e] = [total.get((p, e, i), 0) // n for i in range(count)]
    return books


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every usable row of ``vec_id, embedding, label``, and the codebooks.

    ``code`` has two hex digits for each part, so ``entries`` is at most 256.
    """
    rows = vectors.where(usable(F.col("embedding"), scale)).select(
        "vec_id", "label", F.transform("embedding", lambda x: F.lit(0.0) + _floor(x.cast("double") * scale)).alias("v")
    )
    head = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    dim = head.n if head else 0
    rows = rows.where(F.size("v") == dim)
    books = fit(rows, dim, parts, entries, rounds) if head else [np.zeros((0, 0), dtype=object)] * parts
    kinds = dict(vectors.dtypes)
    coded = rows.mapInArrow(lambda it: _codes(it, dim, books, parts), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return coded, books


def _floor(x: Column) -> Column:
    """Floor that stays a double, so no component is too large for it."""
    return F.when(F.abs(x) < 2**52, F.floor(x).cast("double")).otherwise(x)


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors of equal labels together (nulls are one label)."""
    known = F.count(F.lit(1)) == F.count("error")
    sums = coded.groupBy("label").agg(F.when(known, F.try_sum("error")).alias("label_error"))
    sums = materialize(sums, "label-errors")
    return lookup(coded, sums, ["label"], null_safe=True, bound=sums.count())


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    return sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def codes(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row."""
    coded, books = encode(vectors)
    coded = label_errors(materialize(coded, "codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
