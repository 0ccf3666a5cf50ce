"""BPE encoding and decoding with a tokenizer file whose words end in a mark.

Each short word is merged in place: a row holds its parts and a row beside it the rank
of every adjacent pair; the smallest rank (leftmost first) is searched by
scanning, its boundary deleted, and the two neighbouring ranks refreshed.  The words
of one length that a batch brings are rows of one matrix, so numpy does each of
these steps for all of them at once.  For a word of more than ``SHORT`` bytes the
same merges come from a heap of pairs over linked parts: n log n for any length.

Texts go through in slices of ``SLICE`` bytes.  A task keeps the pieces of words it has met in two generations of up to ``CACHE``
words each, or a slice's if those are more (a full one replaces the older), which saves time and changes nothing.  Texts are read whole, documents are independent rows,
nothing is shuffled.

Defined results: a null or empty text has no tokens and decodes to the empty
text; the special tokens' own strings in a text become their ids, as in the
tokenizers library; repeated rows are encoded each; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import map_arrow, per_document, row_slices, words_of

#: Words of at most so many parts are merged by scanning.
SHORT = 64
#: Words whose pieces each of a worker's two generations keeps.
CACHE = 60_000
#: Bytes of text encoded at a time: bounds the different words, and so the pieces, that are held at once.
SLICE = 1 << 20
#: Rank of a pair that is no merge; slots of the table of ranks (a power of two); ids are below _WIDE.
NONE, SLOTS, _WIDE = 1 << 60, 1 << 20, 1 << 31


#: Blocks that Unicode 16 added or filled up with letters and numbers.  The tokenizers library knows them,
#: and Python's own tables may not yet.
_UNICODE_16 = """
    1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D85 10EC2-10EC4 11380-113E2 116D0-116E3 11BC0-11BF9
    13460-143FA 16100-16139 16D40-16D79 18CFF-18CFF 1CCF0-1CCF9 1E5D0-1E5FA
"""
#: Capital letters (first to last) that Unicode 16 and 17 added, and the first one's small letter.  The tokenizers
#: library knows them, and Python's own tables may not yet.
_CAPITALS = """
    1C89-1C89:1C8A A7CB-A7CB:0264 A7CC-A7CC:A7CD A7CE-A7CE:A7CF A7D2-A7D2:A7D3 A7D4-A7D4:A7D5 A7DA-A7DA:A7DB A7DC-A7DC:019B
    10D50-10D65:10D70 16EA0-16EB8:16EBB
"""
#: Marks since Unicode 10, which the library's older composition takes for characters that neither move nor compose.
_LATE_MARKS = """
    07FD-07FD 0898-089F 08CA-08D3 09FE-09FE 0C3C-0C3C 0D3B-0D3C 0EBA-0EBA 1715-1715 1ABF-1ACE 1DF6-1DFA A82C-A82C 10D24-10D27
    10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 11070-11070 1133B-1133B 1145E-1145E 11839-1183A 11930-11930 11938-11938
    1193D-1193E 11943-11943 119E0-119E0 11A34-11A34 11A47-11A47 11A99-11A99 11D42-11D42 11D44-11D45 11D97-11D97 11F41-11F42
    16FF0-16FF1 1E08F-1E08F 1E130-1E136 1E2AE-1E2AE 1E2EC-1E2EF 1E4EC-1E4EF
"""


def _newer() -> str:
    """Class body of the characters that only the regex module takes for letters or numbers.

    The tokenizers library has Unicode 16, and Python's tables that or a version before.
    """
    blocks = [tuple(int(x, 16) for x in r.split("-")) for r in _UNICODE_16.split()]
    either = regex.compile(r"[\p{L}\p{N}]")
    points = [
        p
        for p in range(0x80, 0x110000)
        if either.match(chr(p)) and unicodedata.category(chr(p))[0] not in "LN" and not any(a <= p <= b for a, b in blocks)
    ]
    runs: list[list[int]] = []
    for p in points:
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) or r"\U0010ffff"


def _small() -> dict[int, int]:
    """The small letter of each of the newer capital letters."""
    out = {}
    for part in _CAPITALS.split():
        first, last, small = (int(x, 16) for x in re.split("[-:]", part))
        out |= {p: small + p - first for p in range(first, last + 1)}
    return out


_SMALL = _small()
_NEWER = _newer()
#: Finds a character that only newer Unicode tables call a letter or a number.
NEWER = regex.compile(f"[{_NEWER}]")
#: Finds (and keeps, in a split) a mark that doesn't compose.
LATE = re.compile("([" + "".join("{}-{}".format(*(chr(int(x, 16)) for x in r.split("-"))) for r in _LATE_MARKS.split()) + "])")
#: All of those, and all newer capital letters, are among these; found faster.
HIGH = re.compile("[\u0530-\U0010ffff]")


def _without_newer(pattern: str) -> str:
    """The pattern with the classes of letters and numbers reduced to the older tables."""
    for kind in ("L", "N"):
        pattern = pattern.replace(f"[^\\s\\p{{L}}\\p{{N}}]", "[^\\s\x00]").replace(f"[\\p{{{kind}}}]", f"[\\p{{{kind}}}--[{_NEWER}]]")
    return pattern.replace("[^\\s\x00]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{_NEWER}])")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free code point from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


def _slots(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - SLOTS.bit_length())).astype(np.int64)


def _together(found: list[tuple[str, str, int]]) -> tuple[str, str, int]:
    return " ".join([f[0] for f in found]), " ".join([f[1] for f in found]), sum([f[2] for f in found])


class Bpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        end, vocab = model["end_of_word_suffix"] or "", model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (*vocab.items(), *self.special.items())}
        self.names = {i: str(i) for i in self.tokens}
        self.of_byte = np.array([vocab[x] for x in byte_letters()], dtype=np.int64)
        self.of_last = np.array([vocab[x + end] for x in byte_letters()], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        # the same ranks in an open hash table, for whole arrays of pairs
        self.slot_key, self.slot_rank, self.probes = np.full(SLOTS, -1), np.full(SLOTS, NONE), 1
        keys = np.array([a * _WIDE + b for a, b in self.ranks], dtype=np.int64)
        for key, at, r in zip(keys.tolist(), _slots(keys).tolist(), self.ranks.values()):
            probes = 1
            while self.slot_key[at] >= 0:
                at, probes = (at + 1) & (SLOTS - 1), probes + 1
            self.slot_key[at], self.slot_rank[at] = key, r
            self.probes = max(self.probes, probes)
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(s for s in steps if s["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.plain = self.words.findall("abcstdmrevl") == ["abcstdmrevl"]  # letters alone are one word
        self.older_words = regex.compile(_without_newer(pattern), regex.V1)
        self.specials = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.cache: dict[str, tuple[str, str, int]] = {}
        self.older: dict[str, tuple[str, str, int]] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of adjacent tokens, ``NONE`` if it is no merge."""
        key = left * _WIDE + right
        at, out = _slots(key), np.full(key.shape, NONE)
        for _ in range(self.probes):
            np.copyto(out, self.slot_rank[at], where=self.slot_key[at] == key)
            at = (at + 1) & (SLOTS - 1)
        return out

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word; short words of one length are merged side by side."""
        out: list[list[int]] = [[]] * len(words)
        data = [w.encode() for w in words]
        by_length: dict[int, list[int]] = {}
        for k, d in enumerate(data):
            by_length.setdefault(len(d), []).append(k)
        for length, own in by_length.items():
            raw = np.frombuffer(b"".join([data[k] for k in own]), dtype=np.uint8).reshape(len(own), length)
            parts = self.of_byte[raw]
            parts[:, -1] = self.of_last[raw[:, -1]]
            if length > SHORT:
                merged = [self._heap(p) for p in parts.tolist()]
            else:
                merged = self._scan(parts)
            for k, p in zip(own, merged):
                out[k] = p
        return out

    def _scan(self, parts: np.ndarray) -> list[list[int]]:
        """Merge rows of tokens of equal length: each round takes every row's smallest rank."""
        done: list[list[int]] = [[]] * len(parts)
        row, near = np.arange(len(parts)), self.rank(parts[:, :-1], parts[:, 1:])
        while len(row):
            width = near.shape[1]
            i = near.argmin(axis=1) if width else np.zeros(len(row), dtype=np.int64)
            each = np.arange(len(row))
            best = near[each, i] if width else np.full(len(row), NONE)
            over = best == NONE
            if over.any():
                for k, p in zip(row[over].tolist(), parts[over].tolist()):
                    done[k] = p
                left = ~over
                row, parts, near, i, best = row[left], parts[left], near[left], i[left], best[left]
                if not len(row):
                    break
                each = np.arange(len(row))
            parts[each, i] = self.merged[best]
            column = np.arange(width)
            parts = np.take_along_axis(parts, column + (column > i[:, None]), axis=1)  # the boundary after part i goes
            near = np.take_along_axis(near, column[:-1] + (column[:-1] >= i[:, None]), axis=1)
            before, after = i > 0, i < width - 1
            at = i[before]
            near[each[before], at - 1] = self.rank(parts[each[before], at - 1], parts[each[before], at])
            at = i[after]
            near[each[after], at] = self.rank(parts[each[after], at], parts[each[after], at + 1])
        return done

    def _heap(self, parts: list[int]) -> list[int]:
        """Merge one long word: a heap of ranked pairs over linked parts."""
        rank = self.ranks.get
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] != a or parts[j] != b:
                continue  # one of the two has gone since
            parts[i], parts[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def pieces(self, words: set[str]) -> dict[str, tuple[str, str, int]]:
        """Of each word the decimal ids and the tokens, joined by a space, and their number."""
        out, todo = {}, []
        for w in words:
            if found := self.cache.get(w) or self.older.get(w):
                out[w] = found
            else:
                todo.append(w)
        name, token = self.names, self.tokens
        for w, ids in zip(todo, self.merge_all(todo)):
            out[w] = " ".join([name[i] for i in ids]), " ".join([token[i] for i in ids]), len(ids)
        if len(self.cache) + len(todo) > CACHE:
            self.cache, self.older = {}, self.cache
        self.cache.update((w, f) for w, f in out.items() if len(w) <= SHORT)
        return out

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens: composed, in lower case (each character by itself)."""
        if self.plain and text.isascii() and text.isalpha():
            return [text.lower()]
        if not text.isascii():
            high = HIGH.search(text)
            parts = LATE.split(text) if high else [text]
            text = "".join([unicodedata.normalize("NFC", p) for p in parts]).replace("Σ", "σ").lower()
            if high:
                text = text.translate(_SMALL)
            return (self.older_words if high and NEWER.search(text) else self.words).findall(text)
        return self.words.findall(text.lower())

    def _found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[tuple[str, str, int]]]:
        """Different runs between ASCII white space of a column, each encoded once: ``starts, codes`` of ``words_of`` and the pieces.

        No word, special token or composition spans such a space.
        """
        starts, codes, runs = words_of(texts)
        lists = []
        for run in runs.to_pylist():
            if "<" in run:
                parts = self.specials.split(run)
                lists.append([w for p in parts for w in ([p] if p in self.special else self.split(p))])
            else:
                lists.append(self.split(run))
        pieces = self.pieces({w for l in lists for w in l} - self.special.keys())
        pieces |= {t: (str(i), t, 1) for t, i in self.special.items()}
        return starts, codes, [pieces[l[0]] if len(l) == 1 else _together([pieces[w] for w in l]) for l in lists]

    def encode_column(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Of each text the ids and the tokens, joined by a space, and their number."""
        starts, codes, found = self._found(texts)
        n = np.array([f[2] for f in found], dtype=np.int64)[codes] if found else np.zeros(0, dtype=np.int64)
        full = n > 0
        offsets = pa.array(np.concatenate([[0], np.cumsum(full)])[starts], pa.int32())
        at = pa.array(codes[full])
        columns = (pa.array([f[k] for f in found], pa.large_string()).take(at) for k in (0, 1))
        ids, tokens = (pc.binary_join(pa.ListArray.from_arrays(offsets, c), pa.scalar(" ", c.type)) for c in columns)
        return ids, tokens, per_document(starts, n)

    def id_lists(self, texts: pa.Array) -> pa.Array:
        """Of each text the list of its ids."""
        starts, codes, found = self._found(texts)
        size = np.array([f[2] for f in found], dtype=np.int64)
        pool = np.array(" ".join([f[0] for f in found if f[2]]).split(), dtype=np.int32)
        n = size[codes] if found else np.zeros(0, dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(n)])
        shift = (np.cumsum(size) - size)[codes] - total[:-1] if found else n  # from a run's ids to their place in the column
        flat = pool[np.repeat(shift, n) + np.arange(total[-1])]
        return pa.ListArray.from_arrays(pa.array(total[starts], pa.int32()), pa.array(flat, pa.int32()))

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        return [int(i) for i in self.encode_column(pa.array([text], pa.string()))[0][0].as_py().split()]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the file names no decoder, so tokens are joined by a space."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


_LOADED: dict[str, Bpe] = {}


def load(spec: str) -> Bpe:
    """The encoder of a tokenizer file's content, one per worker process."""
    key = sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Bpe(json.loads(spec))
    return _LOADED[key]


def token_ids(docs: DataFrame, tokenizer_path: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, ``n_tokens`` and the token ``ids`` (array of int) of its ``text``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(spec.value)
        for b in (part for batch in batches for part in row_slices(batch, "text", SLICE)):
            ids = bpe.id_lists(b.column("text"))
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), ids.value_lengths().cast(pa.int64()), ids], names=[*keep, "n_tokens", "ids"])
        bpe.cache, bpe.older = {}, {}  # a worker lives on, and other operators need its memory

    kinds = dict(docs.dtypes)
    return map_arrow(docs.select(*keep, "text"), run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), "n_tokens long", "ids array<int>"]))


def encode(docs: DataFrame, tokenizer_path: str, keep_text: bool = False) -> DataFrame:
    """Encode and decode every row's ``text``.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and with ``keep_text``
    also ``ids`` (array of int) and ``decoded``.  The tokenizer file is read on the driver
    (a parameter of under 2 MB) and broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(spec.value)
        yield from encoded(bpe, batches)
        bpe.cache, bpe.older = {}, {}  # a worker lives on, and other operators need its memory

    def encoded(bpe: Bpe, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in row_slices(batch, "text", SLICE)):
            ids, decoded, n = bpe.encode_column(b.column("text"))
            hashes = [pa.array([sha256(x.as_buffer()).hexdigest() for x in column], pa.string()) for column in (ids, decoded)]
            out = [b.column("doc_id"), pa.array(n, pa.int64()), *hashes]
            if keep_text:
                out += [pa.array([[int(i) for i in x.split()] for x in ids.to_pylist()], pa.list_(pa.int32())), decoded.cast(pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, names=names[: len(out)])

    more = ", ids array<int>, decoded string" if keep_text else ""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    return map_arrow(docs.select("doc_id", "text"), run, schema)
