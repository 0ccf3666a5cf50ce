"""Token ids of a corpus in binary blocks, compressed by Re-Pair grammars.

Documents are sorted by range into partitions, encoded with a tokenizer file of the
``tokenizers`` library, ended by ``END`` and cut into blocks of ``BLOCK`` ids; a long
document runs over several blocks, so a block's memory is bounded.  In each block
frequent pairs of neighbours become nonterminals, again and again, until no pair is left
that occurs ``LEAST`` times.  A round takes every pair with at least ``1 / SHARE`` of the most frequent one's
occurrences: pairs are counted by one sort, overlapping occurrences settled from the left.

A block is a row of a table that Spark writes (:func:`write_blocks`): its documents and a payload of

    magic ``RPG1``, then little-endian 32-bit ids, terminals, rules, symbols (their numbers), bytes a symbol;
    the terminals (32 bits each, the block's different ids); left and right symbol of each rule;
    the expansion length of each rule (32 bits); the position of every ``MARK``-th symbol (32 bits); the symbols.

Symbols below the number of terminals are terminals, the others rules in order of their making, so
a rule only names earlier symbols.  :func:`decode` gives all ids of a payload, or a range of them by searching the
marks and expanding only the symbols that cover it.

Defined results: null and empty texts have only the end id; rows of equal ``doc_id`` follow each
other by a hash of their text, null ids come first; an empty table has no blocks; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.operators.core import lookup, materialize, running_totals

#: Id at the end of each document; ids of a block; uses that a rule must have; symbols from mark to mark.
END, BLOCK, LEAST, MARK = 2, 1 << 20, 16, 1024
#: A round replaces the pairs with at least this part of the most frequent one's occurrences.
SHARE = 4
#: Bytes of text that are encoded at a time, and pieces that an encoder remembers (in each of two generations).
SLICE, REMEMBERED = 8 << 20, 400_000
#: Symbols of a block: they fit into 16 bits, and a pair of them into 32.
SYMBOLS = 1 << 16
_HEAD = struct.Struct("<4s5I")
_MAGIC = b"RPG1"
BLOCK_SCHEMA = "part int, block int, opened int, closes boolean, n_ids long, doc_ids array<long>, doc_n array<long>, payload binary"


# --- grammar ---------------------------------------------------------------------------------


def _chosen(keys: np.ndarray, least: int, room: int) -> np.ndarray:
    """Pairs that this round replaces, ascending."""
    keys = np.sort(keys)
    ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]), len(keys) - 1)
    n = np.diff(ends, prepend=-1)
    enough = np.flatnonzero(n >= max(least, n.max() // SHARE))
    if len(enough) > room:
        enough = np.sort(enough[np.argsort(-n[enough], kind="stable")[:room]])
    return keys[ends[enough]]


def _places(keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a chosen pair stands, and which; of overlapping ones every second from the left."""
    bits = 18
    slots = lambda k: (k * np.uint32(2654435769)) >> np.uint32(32 - bits)
    table = np.zeros(1 << bits, dtype=np.uint16)
    table[slots(chosen)] = np.arange(len(chosen), dtype=np.uint16)  # of two in a slot one waits for a later round
    which = table.take(slots(keys))
    at = np.flatnonzero(chosen.take(which) == keys)
    new = np.append(True, at[1:] != at[:-1] + 1) if len(at) else np.zeros(0, dtype=bool)
    run = np.flatnonzero(new)
    at = at[(at - at[run][np.cumsum(new) - 1]) % 2 == 0] if len(at) else at
    return at, which[at]


def repair(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``terminals, rules, symbols`` of a block: ``rules`` has two columns, the symbols that a nonterminal stands for."""
    present = np.zeros(int(ids.max(initial=0)) + 1, dtype=bool)
    present[ids] = True
    terminals = np.flatnonzero(present).astype(np.uint32)
    if len(terminals) > SYMBOLS:
        return terminals, np.zeros((0, 2), np.uint32), (np.cumsum(present) - 1)[ids].astype(np.uint32)
    seq = (np.cumsum(present) - 1).astype(np.uint16)[ids]
    rules = [np.zeros((0, 2), np.uint16)]
    n = len(terminals)
    while len(seq) > 1 and n < SYMBOLS:
        keys = (seq[:-1].astype(np.uint32) << 16) | seq[1:]  # left << 16 | right
        chosen = _chosen(keys, least, SYMBOLS - n)
        if not len(chosen):
            break
        at, which = _places(keys, chosen)
        used = np.bincount(which, minlength=len(chosen))
        good = used > 1
        if not good.any():
            break
        if not good.all():
            held = good[which]
            at, which = at[held], which[held]
        names = (n - 1 + np.cumsum(good)).astype(np.uint16)
        rules.append(np.stack([chosen[good] >> 16, chosen[good] & 0xFFFF], axis=1).astype(np.uint16))
        n += int(good.sum())
        seq[at] = names[which]
        left = np.ones(len(seq), dtype=bool)
        left[at + 1] = False
        seq = seq[left]
    return terminals, np.concatenate(rules), seq


def _expanded(terminals: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids that each symbol stands for: ``ids, first, length`` by symbol."""
    n = len(terminals)
    rules = rules.astype(np.int64)
    length = np.ones(n + len(rules), dtype=np.int64)
    seq, owner = np.arange(n + len(rules)), np.arange(n + len(rules))
    while (deep := seq >= n).any():  # one level a turn, over the rules' own symbols only
        n_out = 1 + deep
        at = np.cumsum(n_out) - n_out
        out = np.repeat(seq, n_out)
        out[at[deep]], out[at[deep] + 1] = rules[seq[deep] - n, 0], rules[seq[deep] - n, 1]
        seq, owner = out, np.repeat(owner, n_out)
    length = np.bincount(owner, minlength=n + len(rules))
    return terminals[seq], np.cumsum(length) - length, length


def pack(ids: np.ndarray, least: int = LEAST) -> bytes:
    """Payload of a block."""
    terminals, rules, symbols = repair(ids, least)
    length = _expanded(terminals, rules)[2]
    place = np.cumsum(length[symbols]) - length[symbols]
    width = 2 if symbols.dtype == np.uint16 else 4
    head = _HEAD.pack(_MAGIC, len(ids), len(terminals), len(rules), len(symbols), width)
    form = f"<u{width}"
    parts = [terminals.astype("<u4"), rules[:, 0].astype(form), rules[:, 1].astype(form), length[len(terminals) :].astype("<u4"), place[::MARK].astype("<u4"), symbols.astype(form)]
    return b"".join([head, *(p.tobytes() for p in parts)])


def _parts(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    magic, _, n_terminals, n_rules, n_symbols, width = _HEAD.unpack_from(payload)
    if magic != _MAGIC:
        raise ValueError("not a block of token ids")
    at, out = _HEAD.size, []
    for n, form in ((n_terminals, "<u4"), (n_rules, f"<u{width}"), (n_rules, f"<u{width}"), (n_rules, "<u4"), (-(-n_symbols // MARK), "<u4"), (n_symbols, f"<u{width}")):
        out.append(np.frombuffer(payload, form, n, at))
        at += out[-1].nbytes
    return out[0], np.stack(out[1:3], axis=1), out[3], out[4], out[5]


def decode(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block (all by default)."""
    terminals, rules, rule_length, marks, symbols = _parts(payload)
    n_ids = _HEAD.unpack_from(payload)[1]
    start, stop = max(start, 0), n_ids if stop is None else min(stop, n_ids)
    if start >= stop:
        return np.zeros(0, np.uint32)
    from_mark = int(np.searchsorted(marks, start, "right")) - 1
    to_mark = int(np.searchsorted(marks, stop, "left"))
    symbols = symbols[from_mark * MARK : to_mark * MARK]
    every = np.concatenate([np.ones(len(terminals), np.int64), rule_length.astype(np.int64)])
    place = int(marks[from_mark]) + np.cumsum(every[symbols]) - every[symbols]
    lo, hi = int(np.searchsorted(place, start, "right")) - 1, int(np.searchsorted(place, stop, "left"))
    symbols, first_id = symbols[lo:hi], int(place[lo])
    ids, first, length = _expanded(terminals, rules)
    n = length[symbols]
    at = np.repeat(first[symbols] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return ids[at][start - first_id : stop - first_id]


# --- tokens ----------------------------------------------------------------------------------

def _byte_letters() -> dict[int, str]:
    """Characters that byte-level tokenizers write for bytes: printable ones themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()
# A pre-token for sure: letters of ASCII and Latin-1, with a space before them or not.
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _mask(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, z in ranges:
        out[a : z + 1] = True
    return out


# Classes of bytes.  SOLID begins a character that is no white space (U+0021 to U+007E, U+00C0 to U+0FFF).
_SOLID = _mask((0x21, 0x7E), (0xC3, 0xE0))
_PRINTED = _mask((0x21, 0x7E))
_LETTER = _mask((0x41, 0x5A), (0x61, 0x7A))
#: Marks that end a run of letters: not the apostrophe of contractions, nor what added tokens are made of (looked for in ``Encoder``).
_STOPS = ".,;:!?\"#$%&()*+/=@"
_STOP = _mask(*((ord(c), ord(c)) for c in _STOPS))
_POINT = _mask(*((ord(c), ord(c)) for c in ".,;:!?"))


def _pair_starts() -> np.ndarray:
    """Of each two bytes (first byte the low one), whether a pre-token begins at the second (1) or the first (2), or
    may begin after both (4)."""
    a, b = np.arange(256)[None, :], np.arange(256)[:, None]
    second = (_LETTER[a] & (_STOP[b] | (b == 10))) | (_POINT[a] & (b == 10))
    return (second + 2 * ((a == 32) & _SOLID[b]) + 4 * (_PRINTED[a] & (b == 10))).astype(np.uint8).ravel()


_PAIRS = _pair_starts()


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Whether a byte-level pre-token begins at each byte whatever else the text holds (not all such places).

    That is at a space before a solid character, at a stop or line feed after a letter, at
    a line feed after a point, and at a letter after a line feed that follows a printed character.
    """
    starts = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        pair = _PAIRS[data[:-1] | (data[1:].astype(np.uint16) << 8)]
        starts[:-1] = pair & 2
        starts[1:] |= (pair & 1).view(bool)
        lines = np.flatnonzero(pair[:-1] & 4) + 2
        starts[lines] |= _LETTER[data[lines]]
    return starts


class Encoder:
    """Ids of texts as the ``tokenizers`` library gives them; equal pieces of texts are encoded once.

    For byte-level files without normalizer the ids of a text are those of its pieces, cut
    where a pre-token begins for sure (:func:`piece_starts`).  Texts of other files are encoded whole.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        j = json.loads(spec)
        pre = j.get("pre_tokenizer") or {}
        added = j.get("added_tokens", [])
        plain = all(not re.search(rf"[\s{re.escape(_STOPS)}]", t["content"]) and not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word") for t in added)
        plain = plain and not any(_WORD.fullmatch(t["content"]) for t in added)
        self.by_piece = plain and j.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        """Ids of a text, as 32-bit numbers."""
        whole = text.decode()
        if self.by_piece and _WORD.fullmatch(whole):  # one pre-token: no need to search for others
            letters = whole.replace(" ", _BYTE_LETTERS[32]) if whole.isascii() else text.decode("latin-1").translate(_BYTE_LETTERS)
            return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return array("I", self.tokenizer.encode(whole, add_special_tokens=False).ids).tobytes()

    def pieces(self, texts: list[bytes]) -> list[bytes]:
        """Ids of different pieces."""
        get = self.known.get
        found = [get(t) for t in texts]
        for k, f in enumerate(found):
            if f is None:
                t = texts[k]
                f = found[k] = self.older.get(t) or self.encode(t)
                if len(t) < 40:
                    if len(self.known) >= REMEMBERED:
                        self.known, self.older = {}, self.known
                    self.known[t] = f
        return found

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, one text after the other, and the number of each."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
        if not self.by_piece:
            found = [self.encode(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(found), np.uint32), np.array([len(f) // 4 for f in found], dtype=np.int64)
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        starts = piece_starts(data)
        starts[at[:-1][np.diff(at) > 0]] = True
        cuts = np.append(np.flatnonzero(starts), len(data))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        found = self.pieces(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, begin = np.frombuffer(b"".join(found), np.uint32), np.cumsum(size) - size
        used = coded.indices.to_numpy()
        n = size[used]
        total = np.concatenate([[0], np.cumsum(n)])
        kind = np.int32 if total[-1] < 2**31 else np.int64
        ids = pool[np.repeat((begin[used] - total[:-1]).astype(kind), n) + np.arange(total[-1], dtype=kind)]
        of = np.searchsorted(cuts, at)  # pieces before each text
        return ids, total[of[1:]] - total[of[:-1]]


_LOADED: dict[str, Encoder] = {}


def load(spec: str) -> Encoder:
    """The encoder of a tokenizer file's content, one per worker process."""
    key = sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Encoder(spec)
    return _LOADED[key]


# --- tables ----------------------------------------------------------------------------------


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int | None], list[bool], pa.Array]]:
    """``part, doc_ids, ends, texts`` for up to ``SLICE`` bytes of text.

    A longer text comes in parts that begin where a pre-token does for sure; only the last one ends the document.
    """
    for b in batches:
        size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
        part, ids, texts = b.column("part")[0].as_py() if b.num_rows else 0, b.column("doc_id").to_pylist(), b.column("text")
        a = 0
        while a < b.num_rows:
            z = max(a + 1, int(np.searchsorted(size, size[a] + SLICE, "right")) - 1)
            if size[a + 1] - size[a] <= SLICE:
                yield part, ids[a:z], [True] * (z - a), texts.slice(a, z - a)
            else:
                z = a + 1
                data = np.frombuffer(texts[a].cast(pa.large_string()).cast(pa.large_binary()).as_buffer(), np.uint8)
                at = 0
                while at < len(data):
                    stop = at + SLICE
                    while stop < len(data):  # from a place where a piece begins, a window at a time
                        found = np.flatnonzero(piece_starts(data[stop - 2 : stop + 4096])[2:])
                        if len(found):
                            stop += int(found[0])
                            break
                        stop += 4090
                    stop = min(stop, len(data))
                    yield part, ids[a:z], [stop == len(data)], pa.array([data[at:stop].tobytes().decode()], pa.large_string())
                    at = stop
            a = z


def _blocks(encoder: Encoder, batches: Iterator[pa.RecordBatch], end: int) -> Iterator[pa.RecordBatch]:
    part = block = 0
    held: list[np.ndarray] = []  # ids of the open block
    docs: list[tuple[int | None, int]] = []  # its documents and how many ids of each
    n_held = opened = 0  # opened: the block in which the first document of the open block began
    begun, fresh, goes_on = 0, True, False  # block of the present document's first id; whether the next id begins one, or goes on with one

    def emit(closes: bool) -> pa.RecordBatch:
        ids = np.concatenate(held)
        row = {"part": part, "block": block, "opened": opened, "closes": closes, "n_ids": len(ids), "doc_ids": [d for d, _ in docs], "doc_n": [n for _, n in docs], "payload": pack(ids)}
        kinds = {"part": pa.int32(), "block": pa.int32(), "opened": pa.int32(), "closes": pa.bool_(), "n_ids": pa.int64(), "doc_ids": pa.list_(pa.int64()), "doc_n": pa.list_(pa.int64()), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in kinds.items()], names=list(kinds))

    for part, doc_ids, done, texts in _slices(batches):
        ids, n = encoder.encode_column(texts)
        done = np.array(done, dtype=bool)
        stops = np.cumsum(n + done)
        ids = np.insert(ids, np.cumsum(n)[done], end).astype(np.uint32)
        at = 0
        for doc, stop, closes in zip(doc_ids, stops.tolist(), done.tolist()):
            while at < stop:
                take = min(stop - at, BLOCK - n_held)
                if fresh:
                    begun, fresh = block, False
                if not docs:
                    opened = begun
                if docs and goes_on:
                    docs[-1] = doc, docs[-1][1] + take
                else:
                    docs.append((doc, take))
                held.append(ids[at : at + take])
                at, n_held, goes_on = at + take, n_held + take, True
                if n_held == BLOCK:
                    yield emit(closes and at == stop)
                    block, held, docs, n_held = block + 1, [], [], 0
            if closes:
                fresh, goes_on = True, False
    if n_held:
        yield emit(True)


def write_blocks(docs: DataFrame, tokenizer_path: str, end: int = END) -> DataFrame:
    """Blocks of all documents in ascending ``doc_id`` (columns ``BLOCK_SCHEMA``), to be written as a table.

    ``(part, block)`` is the order of the blocks; ``opened`` is the block of the same part in which a
    block's first document began, and ``closes`` tells whether its last one ends in it.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # a parameter of a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(load(spec.value), batches, end)
        pa.default_memory_pool().release_unused()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]  # equal rows may be told apart, so no value fills a range
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return rows.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, BLOCK_SCHEMA)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of blocks, or their parts: where they stand in the block, how many ids, and the checksum."""
    for batch in batches:
        for b in (batch.slice(k, 1) for k in range(batch.num_rows)):
            r = b.to_pylist()[0]
            ids = np.ascontiguousarray(decode(r["payload"]).astype("<u4"))
            n = np.array(r["doc_n"], dtype=np.int64)
            at = np.cumsum(n) - n
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), n.tolist())]
            last = len(n) - 1
            opened = [r["opened"] if k == 0 else r["block"] for k in range(len(n))]
            whole = [(k > 0 or r["opened"] == r["block"]) and (k < last or r["closes"]) for k in range(len(n))]
            columns = [
                pa.array(r["doc_ids"], pa.int64()), pa.array([r["part"]] * len(n), pa.int32()), pa.array([r["block"]] * len(n), pa.int32()),
                pa.array(opened, pa.int32()), pa.array(whole, pa.bool_()), pa.array(at), pa.array(n), pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "block", "opened", "whole", "place", "n_tokens", "crc"])


def crc_of_both(first: int, second: int, n_second: int) -> int:
    """CRC-32 of two byte strings after each other, from theirs and the length of the second."""
    # moving a checksum over zero bytes is linear over its bits: square the one-byte map as often as needed
    step = [(k >> 1) ^ (0xEDB88320 if k & 1 else 0) for k in (1 << i for i in range(32))]

    def apply(m: list[int], x: int) -> int:
        out = 0
        for i in range(32):
            if x >> i & 1:
                out ^= m[i]
        return out

    for _ in range(3):
        step = [apply(step, x) for x in step]
    while n_second:
        if n_second & 1:
            first = apply(step, first)
        step = [apply(step, x) for x in step]
        n_second >>= 1
    return first ^ second


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for parts in b.column("parts").to_pylist():
            crc = 0
            for p in parts:
                crc = crc_of_both(crc, p["crc"], 4 * p["n_tokens"])
            out.append(crc)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(out, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from written blocks.

    ``start`` is the number of ids of all documents before it; running sums over the blocks give those
    of a block's first id.  Only documents that run over several blocks are grouped again (their parts are
    at most a text's 2 GB in blocks).
    """
    pieces = blocks.select("part", "block", "opened", "closes", "doc_ids", "doc_n", "payload").mapInArrow(
        _pieces, "doc_id long, part int, block int, opened int, whole boolean, place long, n_tokens long, crc long"
    )
    pieces = materialize(pieces, "token-pieces")  # a narrow row a document, read twice: blocks are decoded once
    sums = running_totals(blocks.select("part", "block", "n_ids"), ["part", "block"], [], ["n_ids"])
    firsts = sums.select("part", "block", (F.col("cum_n_ids") - F.col("n_ids")).alias("first"))
    pieces = lookup(pieces, firsts, ["part", "block"], "inner").withColumn("start", F.col("first") + F.col("place"))
    whole = pieces.where("whole").select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))
    part = F.struct("block", "n_tokens", "crc")
    split = pieces.where("not whole").groupBy("part", "opened").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(part)).alias("parts")
    )
    split = split.select("doc_id", "start", "n_tokens", "parts").mapInArrow(_joined, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return whole.unionByName(split)
