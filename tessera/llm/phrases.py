"""Phrase collocations by Toivonen's mining: a sample proposes phrases, a full pass counts them and their negative border.

Phrases are runs of words inside the pieces of a text between stops; everything is per language.

1. A sample of the documents (one in ``SAMPLE`` by a hash) is mined level by level with a lowered threshold.
2. One pass over all documents counts every proposed phrase and the negative border: the phrases
   that were not proposed although the phrases without their first and without their last word were.
   Both are the same test, "both shorter phrases were proposed", so the border is never listed, only met.
   Most of them are rare, so this pass adds up 64-bit hashes, which can only count too much.
3. A border phrase that may be frequent is a failure of the sample: longer phrases that hold it were not counted.
   The next pass counts, with their words and exactly, the phrases whose hash reached the threshold, and expands the
   failures: a phrase that the pass before did not meet is counted if both its shorter phrases may be frequent
   or are themselves counted for the first time now.  So everything above a failure is counted at once, and the set
   is closed: a frequent phrase that no pass counted would have two frequent shorter ones, each counted in
   one of the two passes, and then it is met in this one.  A failure is barely frequent, so little stands above it.

Proposed phrases reach the tasks as one bit set of at most ``FILTER_BITS``, whatever the corpus (smaller for few words); a false
hit makes a pass count a phrase more, never one less.  A task counts the phrases of a slice of texts by exact
codes, Spark adds them up.  Texts longer than a slice are cut at stops.

Scores need only frequent phrases: each part of a frequent phrase is frequent.  All arithmetic is in 64-bit or
decimal integers.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count each
time; ties go to the higher count, then to the phrase's bytes; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tessera.llm.common import arrow_batches
from tessera.operators.core import lookup, materialize

#: Occurrences that a phrase needs, its most words, and the phrases reported for each language.
LEAST, LONGEST, TOP = 100, 5, 2000
#: One in so many documents is sampled.
SAMPLE = 8
#: Most bits of a set of proposed phrases (8 MB), and bits for each word that the sample proposes, which leaves some for phrases.
FILTER_BITS, WORD_BITS = 1 << 26, 64
#: Bytes of text that are counted at a time (their arrays take some 60 times as many).
SLICE = 2 << 20
UNKNOWN = "und"
_COUNTS = "lang string, k int, phrase string, n long"
_STOPS = b".,;:!?\n\x0b\x0c\r"


def _byte_classes() -> np.ndarray:
    """0 for bytes of words, 1 for white space between words, 2 for stops between pieces."""
    out = np.zeros(256, dtype=np.uint8)
    out[[0x20, 0x09]] = 1
    out[list(_STOPS)] = 2
    return out


_CLASS = _byte_classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def sample_least(least: int, part: int) -> int:
    """Lowered threshold in a sample of one in ``part``: two standard deviations below the expected count, 2 at least."""
    mean = least / part
    return max(2, int(mean - 2 * mean**0.5))


# --- words of a slice ------------------------------------------------------------------------


def _cut(text: bytes) -> Iterator[bytes]:
    """A text in parts of up to about ``SLICE`` bytes, cut after stops."""
    a = 0
    while len(text) - a > SLICE:
        found = [text.rfind(_STOPS[k : k + 1], a, a + SLICE) for k in range(len(_STOPS))]
        z = max(found)
        if z < 0:  # no stop: the next one ends the part
            later = [p for k in range(len(_STOPS)) if (p := text.find(_STOPS[k : k + 1], a + SLICE)) >= 0]
            z = min(later, default=len(text) - 1)
        yield text[a : z + 1]
        a = z + 1
    yield text[a:]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list[int], list[str]]]:
    """Texts after each other, where each begins (with the end), and their languages."""
    held: list[bytes] = []
    langs: list[str] = []
    size = 0
    for b in batches:
        for text, lang in zip(b.column("text").cast(pa.large_string()).cast(pa.large_binary()), b.column("lang").to_pylist()):
            text = text.as_py()
            for part in _cut(text) if text else ():
                if held and size + len(part) > SLICE:
                    yield b"".join(held), np.cumsum([0, *map(len, held)]).tolist(), langs
                    held, langs, size = [], [], 0
                held.append(part)
                langs.append(UNKNOWN if lang is None else lang)
                size += len(part)
    if held:
        yield b"".join(held), np.cumsum([0, *map(len, held)]).tolist(), langs


class Words:
    """The words of a slice: a code and a hash of each (by language and word), and whether the next is in its piece."""

    def __init__(self, data: bytes, at: list[int], langs: list[str]):
        raw = np.frombuffer(data, np.uint8)
        kind = _CLASS[raw]
        in_word = kind == 0
        begins = np.array(at[:-1], dtype=np.int64)
        start, stop = in_word.copy(), in_word.copy()
        start[1:] &= ~in_word[:-1]
        start[begins] = in_word[begins]
        stop[:-1] &= ~in_word[1:]
        stop[begins[1:] - 1] = in_word[begins[1:] - 1]
        first = np.flatnonzero(start)
        length = np.flatnonzero(stop) - first + 1
        breaks = kind == 2
        breaks[begins] = True
        piece = np.cumsum(breaks, dtype=np.int32)[first]
        self.joined = piece[1:] == piece[:-1]
        ends = np.concatenate([[0], np.cumsum(length)])
        words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_LOWER[raw[in_word]])])
        coded = words.dictionary_encode()
        names = sorted(set(langs))
        lang_of = np.array([names.index(x) for x in langs], dtype=np.int64)[np.searchsorted(begins, first, "right") - 1]
        both = pa.array(lang_of * max(len(coded.dictionary), 1) + coded.indices.to_numpy()).dictionary_encode()
        key = both.dictionary.to_numpy()
        self.code = both.indices.to_numpy().astype(np.int64)
        self.lang = pa.array(names, pa.string()).take(pa.array(key // max(len(coded.dictionary), 1)))
        self.word = coded.dictionary.take(pa.array(key % max(len(coded.dictionary), 1)))
        seeds = [xxh3_64_intdigest(x.encode()) for x in names]
        hashes = [xxh3_64_intdigest(w, seeds[k]) for w, k in zip(self.word.to_pylist(), (key // max(len(coded.dictionary), 1)).tolist())]
        self.hash = np.array(hashes, dtype=np.uint64)[self.code]
        self.n = len(first)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers, well mixed."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _in(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether both bits of hashes are set."""
    mask = np.uint64(8 * len(bits) - 1)
    out = np.ones(len(h), dtype=bool)
    for place in (h & mask, (h >> np.uint64(32)) & mask):
        out &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


class _Level:
    """The phrases of ``k`` words at some places of a slice: their places, hashes and exact codes."""

    def __init__(self, w: Words):
        self.k, self.at, self.h, self.code, self.w = 1, np.arange(w.n), w.hash, w.code, w

    def longer(self, grows: np.ndarray) -> None:
        """Goes on to the phrases of one word more that begin where ``grows`` (by place, one more than words) holds here and at the next place."""
        w, keep = self.w, grows[self.at] & grows[self.at + 1]
        if self.k == 1 and w.n:
            keep[:-1] &= w.joined
        at, last = self.at[keep], self.at[keep] + self.k
        packed = pa.array(self.code[keep] * len(w.word) + w.code[last]).dictionary_encode()  # codes stay below the number of words
        self.code = packed.indices.to_numpy().astype(np.int64)
        self.h = self.h[keep] * np.uint64(0x9E3779B97F4A7C15) + w.hash[last]
        self.at, self.k = at, self.k + 1

    def different(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the different phrases among the wanted: one row of each, and how often it stands."""
        coded = pa.array(self.code[wanted]).dictionary_encode()
        which, rows = coded.indices.to_numpy(), np.flatnonzero(wanted)
        one = np.empty(len(coded.dictionary), dtype=np.int64)
        one[which[::-1]] = rows[::-1]
        return one, np.bincount(which, minlength=len(one))

    def spread(self, values: np.ndarray) -> np.ndarray:
        """Values of the phrases by place; False where none is."""
        out = np.zeros(self.w.n + 1, dtype=bool)
        out[self.at] = values
        return out


def _hashed(batches: Iterator[pa.RecordBatch], proposed: np.ndarray, levels: range) -> Iterator[pa.RecordBatch]:
    """``h, n`` of the different phrases of each slice whose shorter phrases are both proposed."""
    with np.errstate(over="ignore"):
        for slice_ in _slices(batches):
            here = _Level(Words(*slice_))
            for k in range(1, levels.stop):
                mixed = _mixed(here.h)
                if k in levels and len(here.at):
                    one, n = here.different(np.ones(len(here.at), dtype=bool))
                    yield pa.RecordBatch.from_arrays([pa.array(mixed[one].view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])
                if k + 1 < levels.stop:
                    here.longer(here.spread(_in(mixed, proposed)))


def _counted(batches: Iterator[pa.RecordBatch], proposed: np.ndarray, known: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_COUNTS`` of each slice: phrases that the pass with ``proposed`` met and ``known`` may hold, and those above
    them that it did not meet; ``k`` 0 has the number of words."""
    with np.errstate(over="ignore"):
        for slice_ in _slices(batches):
            w = Words(*slice_)
            if not w.n:
                continue
            total = pa.table({"lang": w.lang, "n": np.bincount(w.code, minlength=len(w.word))}).group_by("lang").aggregate([("n", "sum")])
            yield _rows(total.column("lang").combine_chunks(), 0, pa.array([""] * total.num_rows, pa.string()), total.column("n_sum").to_numpy())
            here, met = _Level(w), np.ones(w.n, dtype=bool)
            for k in range(1, longest + 1):
                mixed = _mixed(here.h)
                wanted = ~met | _in(mixed, known)
                one, n = here.different(wanted)
                words = [w.word.take(pa.array(w.code[here.at[one] + j])).cast(pa.large_string()) for j in range(k)]
                text = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if k > 1 else words[0]
                if len(one):
                    yield _rows(w.lang.take(pa.array(w.code[here.at[one]])), k, text.cast(pa.string()), n)
                if k < longest:
                    before = here.spread(met & _in(mixed, proposed))
                    here.longer(here.spread(wanted))
                    met = before[here.at] & before[here.at + 1]


def _rows(lang: pa.Array, k: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(n), k, np.int32)), phrase, pa.array(n.astype(np.int64))], names=["lang", "k", "phrase", "n"])


# --- passes ----------------------------------------------------------------------------------


def _pass(docs: DataFrame, count: Callable[..., Iterator[pa.RecordBatch]], sets: list[Broadcast], last: object, schema: str, kept: Column) -> DataFrame:
    """One pass over the texts: counts of the slices added up, those where ``kept`` holds written as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from count(batches, *[s.value for s in sets], last)
        pa.default_memory_pool().release_unused()

    found = docs.select("lang", "text").mapInArrow(run, schema)
    total = found.groupBy(*[c for c in found.columns if c != "n"]).agg(F.sum("n").alias("n"))
    with arrow_batches(docs.sparkSession):
        return materialize(total.where(kept), "phrases")


def _set_bits(bits: np.ndarray, hashes: DataFrame) -> np.ndarray:
    """``bits`` with two more for each hash ``h``; at most ``FILTER_BITS / 64`` rows come back."""
    size = F.lit(8 * len(bits) - 1).cast("long")
    place = F.explode(F.array(F.col("h").bitwiseAND(size), F.shiftrightunsigned("h", 32).bitwiseAND(size)))
    places = hashes.select(place.alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("x")).toArrow()
    out = bits.copy()
    at = words.column("w").to_numpy().astype(np.int64)
    out.view("<u8")[at] |= words.column("x").to_numpy().astype(np.int64).view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE, proposing: int | None = None, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, k, phrase, n`` of every phrase of up to ``longest`` words (``k``) with ``least`` occurrences; ``k`` 0: all words.

    ``proposing`` is the threshold in the sample (:func:`sample_least`); any value gives the same rows, with more or less
    counting.
    """
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text", F.xxhash64("doc_id", "text").alias("dealt"))
    part = docs.where(F.pmod("dealt", F.lit(sample)) == 0)
    proposing = sample_least(least, sample) if proposing is None else proposing
    send = docs.sparkSession.sparkContext.broadcast
    sets = [send(np.zeros(8, dtype=np.uint8))]
    for k in range(1, longest):
        grown = _pass(part, _hashed, sets, range(k, k + 1), "h long, n long", F.col("n") >= proposing)
        n = grown.count()
        if not n:
            break
        bits = sets[0].value if k > 1 else np.zeros(min(filter_bits, max(1 << 9, 1 << (WORD_BITS * n - 1).bit_length())) // 8, dtype=np.uint8)
        sets[0].destroy()
        sets = [send(_set_bits(bits, grown))]
    perhaps = _pass(docs, _hashed, sets, range(1, longest + 1), "h long, n long", F.col("n") >= least)
    sets.append(send(_set_bits(np.zeros_like(sets[0].value), perhaps)))
    found = _pass(docs, _counted, sets, longest, _COUNTS, (F.col("n") >= least) | (F.col("k") == 0))
    for x in sets:  # the tables are written
        x.destroy()
    return found


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, **sampling) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of each language that stand together most.

    A phrase is scored by its weakest cut, and left out where a longer one occurs as often.
    """
    found = frequent_phrases(docs, least, longest, **sampling)
    total = found.where("k = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    counts = found.where("k > 0").select("lang", "phrase", F.col("n").alias("f"))
    words = F.split("phrase", " ")
    cuts = found.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("*", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("first"), F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):  # every part of a frequent phrase is frequent
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = materialize(cuts, "cuts")
    # a longer phrase as frequent as a part of it implies one that is a single word longer
    whole = cuts.where("k > 2 and cut = k - 1 and a >= l").select("lang", F.col("first").alias("phrase"))
    whole = whole.unionByName(cuts.where("k > 2 and cut = 1 and a >= r").select("lang", F.col("rest").alias("phrase"))).distinct()
    total = materialize(total, "words")
    cuts = lookup(cuts, total, ["lang"], "inner", bound=total.count())
    exact = {c: F.col(c).cast("decimal(17,0)") for c in ("a", "n", "l", "r")}
    score = F.expr("(cast(1000 as decimal(4,0)) * a_ * n_) div (l_ * r_)")
    cuts = cuts.withColumns({f"{c}_": x for c, x in exact.items()}).withColumn("score", score.cast("long"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")
    left = best.join(whole, ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
