"""Quality rules per document, and host-level verdicts from shrunk failure rates.

Every document is held against a few text rules.  Failures are summed by host (the
``source``), each host's failure rate is shrunk towards the mean of all hosts by an
empirical beta prior (moment estimate over hosts), and a host goes with all its documents if most of them fail
even so and its rate lies far above what hosts are like.  Verdicts go back by a join that Spark
can split, so one host may hold a third of all rows.

Defined results: a null text has no words (it fails for its length); a null host is
a host of its own; repeated rows are documents each; an empty table gives no rows;
extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import distinct, document_of, map_arrow, per_document, words_of
from tessera.operators.core import attach_row, materialize

#: A document with fewer words fails.
MIN_WORDS = 50
#: A document fails if more than this share of its words is in repeated three-word windows.
MAX_REPEATED = 0.5
#: Further rules that count against a host, none against a single document.
MAX_SYMBOLS_PER_WORD, MAX_DUPLICATE_LINES, MEAN_WORD = 0.3, 0.5, (2, 20)
#: A host goes if its shrunk rate of failed documents reaches this, and lies this many of the prior's
#: standard deviations above its mean.
HOST_RATE, HOST_SPREAD = 0.5, 3.0
#: Weight of the prior, in documents, where the hosts' rates do not differ at all.
EVEN_WEIGHT = 1e4
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts that only the rules use.
MORE_COUNTS = ("n_lines",)


def repeated_words(starts: np.ndarray, codes: np.ndarray, kinds: int) -> np.ndarray:
    """Per document, the words inside three-word windows that occur twice or more in it."""
    n = len(codes)
    if n < 3:
        return np.zeros(len(starts) - 1, dtype=np.int64)
    doc = document_of(starts)
    at = np.flatnonzero(doc[: n - 2] == doc[2:])  # windows inside one document
    pair, last = codes[:-2][at] * kinds + codes[1:-1][at], codes[2:][at]
    if kinds >= 1 << 21:  # keep keys in 63 bits: number the pairs that occur
        pair = np.searchsorted(distinct(pair), pair)
    key = pair * kinds + last
    order = np.argsort(key, kind="stable")  # equal windows stay in the order of documents
    key, doc = key[order], doc[at][order]
    same = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order] = np.append(same, False) | np.append(False, same)
    hit = np.zeros(n, dtype=bool)
    for k in range(3):
        hit[at[twice] + k] = True
    return per_document(starts, hit.astype(np.int64))


def _spans(lists: pa.ListArray) -> np.ndarray:
    return lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()


def count_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = pc.fill_null(b.column("text").cast(pa.large_string()), "")
        starts, codes, words = words_of(texts)
        points = pc.utf8_length(words).to_numpy().astype(np.int64) if len(words) else np.zeros(0, dtype=np.int64)
        lines = pc.split_pattern(texts, "\n")
        at = _spans(lists=lines)
        flat = lines.flatten()
        full = pc.greater(pc.binary_length(pc.ascii_trim(flat, characters=" \t\n\v\f\r")), 0).to_numpy(zero_copy_only=False)
        enc = flat.dictionary_encode()
        line_doc, code = document_of(at)[full], enc.indices.to_numpy().astype(np.int64)[full]
        n_docs = len(texts)
        kinds = distinct(line_doc * max(len(enc.dictionary), 1) + code) // max(len(enc.dictionary), 1)
        symbols = pc.subtract(pc.binary_length(texts), pc.binary_length(pc.replace_substring_regex(texts, r"[#*$%&|<>]+", "")))
        out = {
            "doc_id": b.column("doc_id"),
            "host": b.column("host"),
            "n_words": np.diff(starts),
            "word_chars": per_document(starts, points[codes]),
            "n_symbols": symbols.cast(pa.int64()),
            "n_dup_lines": np.bincount(line_doc, minlength=n_docs) - np.bincount(kinds, minlength=n_docs),
            "n_repeat_words": repeated_words(starts, codes, max(len(words), 1)),
            "n_lines": np.bincount(line_doc, minlength=n_docs),
        }
        yield pa.RecordBatch.from_arrays([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in out.values()], names=list(out))


def host_verdicts(counts: DataFrame, failed: Column, host_rate: float = HOST_RATE) -> DataFrame:
    """``host, host_docs, host_failed, host_rate, host_kept``: rates shrunk by an empirical beta prior.

    Prior: mean m and variance v of the hosts' rates give a beta with weight m(1 - m)/v - 1, at least 1 document
    (``EVEN_WEIGHT`` if v is 0).  A host goes at a shrunk rate of ``host_rate`` or more that is also
    ``HOST_SPREAD`` standard deviations of that beta above m.
    """
    hosts = counts.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), F.sum(failed.cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    prior = hosts.agg((F.sum("host_failed") / F.sum("host_docs")).alias("m"), F.var_pop(rate).alias("v"))
    even = F.col("m") * (1 - F.col("m"))
    weight = F.when(F.col("v") > 0, F.greatest(even / F.col("v") - 1, F.lit(1.0))).otherwise(EVEN_WEIGHT)
    shrunk = (F.col("host_failed") + F.col("m") * weight) / (F.col("host_docs") + weight)
    far = shrunk >= F.col("m") + HOST_SPREAD * F.sqrt(even / (weight + 1))
    return attach_row(hosts, prior).select("host", "host_docs", "host_failed", shrunk.alias("host_rate"), (~((shrunk >= host_rate) & far)).alias("host_kept"))


def judge(docs: DataFrame, host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """Counts, rule failures and verdict of each row of ``docs`` (``doc_id, text`` and the host column)."""
    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds['doc_id']}, host {kinds[host]}, " + ", ".join(f"{c} long" for c in (*COUNTS, *MORE_COUNTS))
    counts = materialize(map_arrow(docs.select("doc_id", "text", F.col(host).alias("host")), count_rules, schema), "quality")
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    more = (
        base
        | (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * F.col("n_words"))
        | (F.col("n_dup_lines") > MAX_DUPLICATE_LINES * F.col("n_lines"))
        | ~F.col("word_chars").between(MEAN_WORD[0] * F.col("n_words"), MEAN_WORD[1] * F.col("n_words"))
    )
    verdicts = host_verdicts(counts, more, host_rate).withColumnRenamed("host", "judged_host")
    out = counts.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host")), "left")
    return out.select("doc_id", "host", *COUNTS, base.alias("base_failed"), more.alias("any_failed"), "host_rate", (~base & F.col("host_kept")).alias("kept"))
