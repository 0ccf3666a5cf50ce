"""Secrets in whole texts: fixed shapes, and strings that pass a battery of randomness tests.

Fixed shapes (assignments, access keys, long hex runs) are found by patterns.  Other
runs of key characters are candidates.  Each gets an encoding by the characters it
uses, and over that alphabet a chi-squared test of uniformity, a runs test (above
and below the middle of the alphabet) and a lag-1 serial-correlation test; a
candidate that any of them rejects at ``ALPHA`` is not random.

What passes may still be ordinary text that looks random by chance, short strings above all.  So its likelihood as a
random string of its encoding is compared with that as ordinary text, by the pairs of neighbouring key
characters of *all* documents.  Under ordinary text the ratio is above x with a probability of at most 1 / x, so
its inverse (times the number of encodings tried) is a p-value, and longer strings reach smaller ones.  The
p-values of all candidates that the battery did not reject go through Benjamini-Hochberg: the cut comes from a
histogram of fixed bins that Spark sums, so the expected share of false finds is at most ``FDR`` at every size.

Defined results: a null or empty text has no spans; repeated rows are searched
each, and count as often as they occur; extra columns are ignored.  Offsets
count code points, ends are exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow
from tessera.operators.core import materialize

#: Kinds in the order in which they are listed; the method adds the last.
KINDS = ("assign", "access", "hex", "random")
#: Level of each test of the battery, and the share of false finds allowed.
ALPHA, FDR = 1e-3, 0.01
#: Bins of the evidence (minus log p) by which candidates are ranked: width, and the greatest evidence told apart.
BIN, HIGHEST = 0.05, 500.0
#: Counts that a character's own frequency weighs beside those of a pair.
BACKOFF = 4.0

_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")
_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_DIGIT, _LOWER, _UPPER = re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets of the encodings, the narrowest first.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": _LETTERS + "234567",
    "base36": "0123456789" + _LETTERS.lower(),
    "BASE36": "0123456789" + _LETTERS,
    "base62": "0123456789" + _LETTERS + _LETTERS.lower(),
    "base64": _LETTERS + _LETTERS.lower() + "0123456789+/",
    "base64url": _LETTERS + _LETTERS.lower() + "0123456789-_",
    "any": _LETTERS + _LETTERS.lower() + "0123456789+/-_",
}
_SETS = {name: frozenset(a) for name, a in ENCODINGS.items()}
_PLACE = {name: {c: i for i, c in enumerate(a)} for name, a in ENCODINGS.items()}

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed shapes, by start and kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def encoding_of(run: str) -> str:
    used = set(run)
    return next(name for name, s in _SETS.items() if used <= s)


def upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(run: str, encoding: str) -> tuple[float, float, float]:
    """p-values, for a random string, of uniformity (both sides), runs and serial correlation."""
    n, k = len(run), len(ENCODINGS[encoding])
    x = np.array([_PLACE[encoding][c] for c in run], dtype=np.float64)
    chi = k / n * sum(c * c for c in Counter(run).values()) - n
    z = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1))) if chi > 0 else -9.0  # Wilson-Hilferty
    # sparse counts: fewer than one per symbol widen the tails, so the lower side is only held against repeats of a cycle
    uniform = min(1.0, 2 * min(upper_normal(z), upper_normal(-z) if n >= 2 * k else 1.0))
    above = x >= k / 2
    ups = int(above.sum())
    if 0 < ups < n:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        mean = 1 + 2 * ups * (n - ups) / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_runs = 2 * upper_normal(abs(runs - mean) / spread)
    else:
        p_runs = 0.0
    d = x - x.mean()
    square = float(d @ d)
    serial = 2 * upper_normal(abs(float(d[1:] @ d[:-1]) / square + 1 / n) * math.sqrt(n)) if square > 0 else 0.0
    return uniform, p_runs, serial


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int, str, bool]]:
    """Start, end, text and verdict of the battery, of runs outside ``base``."""
    for m in _CANDIDATE.finditer(text):
        run = m[0]
        if bool(_DIGIT.search(run)) + bool(_LOWER.search(run)) + bool(_UPPER.search(run)) < 2:
            continue
        if any(a < m.end() and m.start() < b for a, _, b in base):
            continue
        yield m.start(), m.end(), run, min(battery(run, encoding_of(run))) >= ALPHA


#: Key characters; every other byte is one class of its own after them.
_KEY = ENCODINGS["any"]
_OTHER = len(_KEY)
_KEY_OF = np.full(256, _OTHER, dtype=np.int64)
_KEY_OF[np.frombuffer(_KEY.encode(), np.uint8)] = np.arange(_OTHER)
_SIDE = _OTHER + 1


def pair_counts(raw: np.ndarray) -> np.ndarray:
    """How often each class of bytes follows each (flat, ``_SIDE`` by ``_SIDE``); a text begins after another byte."""
    k = _KEY_OF[raw]
    return np.bincount(np.append(_OTHER, k[:-1]) * _SIDE + k, minlength=_SIDE * _SIDE) if len(k) else np.zeros(_SIDE * _SIDE, dtype=np.int64)


def evidence(run: str, pairs: np.ndarray) -> float:
    """Minus the log of the p-value that ordinary text looks that random: the log-likelihood ratio, less that of the choice of encodings.

    ``pairs`` (``_SIDE`` by ``_SIDE``) counts the whole corpus; the run's own pairs are taken out of it, or a key would vouch for
    itself where its pairs are rare.  A pair's probability backs off to that of its second character with a weight of ``BACKOFF``.
    """
    k = _KEY_OF[np.frombuffer(run.encode(), np.uint8)]
    before = np.append(_OTHER, k[:-1])
    own = np.bincount(before * _SIDE + k, minlength=_SIDE * _SIDE).reshape(_SIDE, _SIDE)
    left = np.maximum(pairs - own, 0)[:, :_OTHER]
    single = left.sum(axis=0) + 0.5
    single = single / single.sum()
    ordinary = (left[before, k] + BACKOFF * single[k]) / (left[before].sum(axis=1) + BACKOFF)
    return -len(run) * math.log(len(ENCODINGS[encoding_of(run)])) - float(np.log(ordinary).sum()) - math.log(len(ENCODINGS))


_CAND = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("run", pa.string()), ("random", pa.bool_())])
_BASE = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])


def scan(kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and one with the task's counts of neighbouring characters at the end."""
    names = ["doc_id", "is_doc", "n_assign", "n_access", "n_hex", "base_sha256", "base", "candidates", "pairs"]
    pairs = np.zeros(_SIDE * _SIDE, dtype=np.int64)
    for b in batches:
        rows: list[list] = [[], [], [], [], [], []]
        for text in b.column("text").to_pylist():
            text = text or ""
            raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
            pairs += pair_counts(raw)
            base = base_spans(text)
            shown = ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in base)
            for column, x in zip(rows, (*(sum(s[1] == k for s in base) for k in range(3)), sha256(shown.encode()).hexdigest(), base, [*candidates(text, base)])):
                column.append(x)
        n = b.num_rows
        kinds = [pa.int64()] * 3 + [pa.string()]
        own = [pa.array(c, t) for c, t in zip(rows, kinds)]
        own += [pa.array([[dict(zip(("start", "kind", "end"), s)) for s in d] for d in rows[4]], pa.list_(_BASE))]
        own += [pa.array([[dict(zip(("start", "end", "run", "random"), s)) for s in d] for d in rows[5]], pa.list_(_CAND))]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([True] * n), *own, pa.nulls(n, pa.list_(pa.int64()))], names=names)
    last = [pa.nulls(1, kind), pa.array([False]), *(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(_BASE), pa.list_(_CAND)))]
    yield pa.RecordBatch.from_arrays([*last, pa.array([pairs.tolist()], pa.list_(pa.int64()))], names=names)


def cut(histogram: list[tuple[int, int]], fdr: float = FDR) -> float:
    """Benjamini-Hochberg over a histogram of evidence (bin -> candidates): candidates from the returned evidence on are found."""
    total, above, best = sum(n for _, n in histogram), 0, math.inf
    for k, n in sorted(histogram, reverse=True):
        above += n
        if math.exp(-max(k, 0) * BIN) <= fdr * above / total:  # every p-value of the bin counts as its largest
            best = k * BIN
    return best


def with_evidence(pairs: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = pairs.reshape(_SIDE, _SIDE)
    for b in batches:
        found = [[min(evidence(c["run"], pairs), HIGHEST) if c["random"] else None for c in row] for row in b.column("candidates").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.float64()))], names=[*b.schema.names, "evidence"])


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): base counts, digest of the base spans, and all spans."""
    spark, doc_type = docs.sparkSession, docs.schema["doc_id"].dataType
    kind = pa.int64() if doc_type.simpleString() == "bigint" else pa.int32() if doc_type.simpleString() == "int" else pa.string()
    schema = (
        f"doc_id {doc_type.simpleString()}, is_doc boolean, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "base array<struct<start:long,kind:int,end:long>>, "
        "candidates array<struct<start:long,end:long,run:string,random:boolean>>, pairs array<long>"
    )
    rows = materialize(map_arrow(docs.select("doc_id", "text"), lambda it: scan(kind, it), schema), "secrets")
    # a row for each pair of classes of characters, some thousands whatever the corpus
    seen = rows.where(~F.col("is_doc")).select(F.posexplode("pairs").alias("pair", "n")).where("n > 0").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(_SIDE * _SIDE, dtype=np.int64)
    for r in seen:
        pairs[r.pair] = r.n
    own = rows.where("is_doc").drop("is_doc", "pairs")
    scored = own.mapInArrow(lambda it: with_evidence(pairs, it), ", ".join(f"{c} {t}" for c, t in own.dtypes) + ", evidence array<double>")
    scored = materialize(scored, "scored")
    bins = scored.select(F.explode("evidence").alias("e")).where("e is not null").select(F.floor(F.col("e") / BIN).alias("bin")).groupBy("bin").count()
    # as many rows as bins: evidence below 0 is never enough and counts as one bin
    bins = bins.groupBy(F.greatest("bin", F.lit(-1)).alias("bin")).agg(F.sum("count").alias("n")).collect()
    limit = cut([(r["bin"], r["n"]) for r in bins], fdr)
    found = F.transform(
        F.filter(F.arrays_zip("candidates", "evidence"), lambda c: c["evidence"] >= F.lit(limit)),
        lambda c: F.struct(c["candidates"]["start"].alias("start"), F.lit(3).alias("kind"), c["candidates"]["end"].alias("end")),
    )
    names = F.array(*map(F.lit, KINDS))
    shown = F.array_join(
        F.transform(F.array_sort(F.concat("base", found)), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )
    return scored.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", shown.alias("spans"))
