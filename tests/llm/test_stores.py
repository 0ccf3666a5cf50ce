"""Token blocks, part codes and phrases on hand-made rows and against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import part_codes, phrases, token_store
from tessera.operators.core import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, part int, k int, n long, label int"
ODD = [" ", "a", "re", "\n", ".", " ", "é", "字", "<|endoftext|>", "'s", "1", "  ", "!\n", " ", "\x00", " ", "İ"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return [None, "", "#", " \n\t"] + ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 300))) for _ in range(n)]


def ids_of(text):
    return np.array([*Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids, token_store.END], dtype="<u4")


# --- token blocks ----------------------------------------------------------------------------


def expected_documents(rows):
    at, out = 0, []
    for doc_id, text in rows:
        ids = ids_of(text)
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_documents_come_back_from_their_blocks(spark):
    texts = odd_texts(40) + ["word foo. bar " * 2000, "x" * 3000]
    rows = [(i, t, None, None, None, 7, 7, 7, 7, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[9], rows[9], (None, "last? no, first", *rows[0][2:])], SCHEMA).repartition(3)
    blocks = materialize(token_store.write_blocks(docs, TOKENIZER))
    got = [tuple(r) for r in token_store.read_documents(blocks).orderBy("start").collect()]
    want = expected_documents([(None, "last? no, first"), *((i, t) for i, t in enumerate(texts) for _ in range(3 if i == 9 else 1))])
    assert got == want
    assert token_store.read_documents(materialize(token_store.write_blocks(docs.limit(0), TOKENIZER))).count() == 0


def test_long_documents_run_over_blocks_and_slices(monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK", 64)
    monkeypatch.setattr(token_store, "SLICE", 300)
    texts = odd_texts(40, 2) + ["word foo. bar " * 1000, "x" * 20000, "a b " * 64]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), pa.array([3] * len(texts), pa.int32())], names=["doc_id", "text", "part"])
    with open(TOKENIZER, encoding="utf-8") as f:
        blocks = list(token_store._blocks(token_store.load(f.read()), iter([batch.slice(0, 20), batch.slice(20)]), token_store.END))
    rows = [b.to_pylist()[0] for b in blocks]
    want = [ids_of(t) for t in texts]
    assert all(r["n_ids"] == sum(r["doc_n"]) == (64 if r is not rows[-1] else r["n_ids"]) for r in rows)
    assert np.array_equal(np.concatenate([token_store.decode(r["payload"]) for r in rows]), np.concatenate(want))
    pieces, split = [p for b in token_store._pieces(iter(blocks)) for p in b.to_pylist()], defaultdict(list)
    for p in pieces:
        if p["whole"]:
            assert (p["n_tokens"], p["crc"]) == (len(want[p["doc_id"]]), zlib.crc32(want[p["doc_id"]].tobytes()))
        else:
            split[p["opened"]].append(p)
    assert {p["doc_id"] for p in pieces} == set(range(len(texts))) and len(split) > 10
    for parts in split.values():
        crc = 0
        for p in sorted(parts, key=lambda p: p["block"]):
            crc = token_store.crc_of_both(crc, p["crc"], 4 * p["n_tokens"])
        (doc,) = {p["doc_id"] for p in parts}
        assert crc == zlib.crc32(want[doc].tobytes())


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    kinds = [rng.integers(0, 5, 4000), np.zeros(5001, np.int64), rng.zipf(1.3, 30000) % 50257, np.tile(rng.integers(0, 90000, 37), 300), np.zeros(0, np.int64), np.arange(70000)]
    ids = kinds[seed].astype(np.uint32)
    payload = token_store.pack(ids, least=4)
    assert np.array_equal(token_store.decode(payload), ids)
    for _ in range(50):
        a, z = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert np.array_equal(token_store.decode(payload, a, z), ids[a:z])
    terminals, rules, symbols = token_store.repair(ids, least=4)
    if len(symbols) > 1 and len(terminals) + len(rules) < token_store.SYMBOLS:  # no pair is left that occurs 4 times without overlap
        pairs = Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist()))
        assert all(n < 4 or a == b for (a, b), n in pairs.items())
    assert all(max(r) < len(terminals) + k for k, r in enumerate(rules.tolist()))
    if seed in (1, 3):
        assert len(payload) < len(ids)


def test_checksums_of_parts_join():
    rng = random.Random(3)
    for _ in range(50):
        a, b = rng.randbytes(rng.randint(0, 99)), rng.randbytes(rng.randint(0, 5000))
        assert token_store.crc_of_both(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


# --- part codes ------------------------------------------------------------------------------


def expected_codes(rows, parts=16, entries=64, rounds=2):
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [r for r in whole if len(r[1]) == len(whole[0][1])]
    at = [k * len(whole[0][1]) // parts for k in range(parts + 1)]
    books = [[r[1][a:z] for r in whole[:entries]] for a, z in zip(at, at[1:])]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, (a, z) in enumerate(zip(at, at[1:])):
            own = defaultdict(list)
            for r in whole:
                own[near(r[1][a:z], books[p])[0]].append(r[1][a:z])
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else b for e, b in enumerate(books[p])]
    coded = [(i, label, [near(v[a:z], b) for a, z, b in zip(at, at[1:], books)]) for i, v, label in whole]
    total = Counter()
    for _, label, found in coded:
        total[label] += sum(d for _, d in found)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    # the contract's columns; errors beyond 64 bits are null
    in_64 = lambda x: x if x < 2**63 else None
    return [(i, "".join(f"{e:02x}" for e, _ in f), in_64(sum(d for _, d in f)), in_64(total[label]), sha) for i, label, f in coded]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("dim, n, scale", [(32, 300, 1.0), (20, 90, 3.0), (7, 30, 1.0), (32, 150, 1e16), (16, 1, 1.0)])
def test_codes_equal_brute_force(spark, dim, n, scale):
    rng = random.Random(dim)
    pool = [[rng.gauss(0, scale) if rng.random() < 0.9 else rng.choice([0.0, -0.0, 1.0]) for _ in range(dim)] for _ in range(n // 2 + 1)]
    rows = [(rng.choice([i, i, 3]), rng.choice(pool), rng.choice([0, 1, 1, None])) for i in range(n)]
    rows += [(5000, None, 1), (5001, [None] * dim, 1), (5002, [float("nan")] * dim, 1), (5003, [float("inf")] + [1.0] * (dim - 1), 1), (5004, [1.0], 1), (None, pool[0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("clash")).withColumn("error", F.lit(1))
    assert rows_of(part_codes.codes(vectors)) == sorted(expected_codes(rows), key=str)


def test_codes_of_no_rows(spark):
    assert part_codes.codes(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_traversal_in_small_slices_finds_the_nearest_entry(monkeypatch):
    monkeypatch.setattr(part_codes, "NODES", 3)
    rng = np.random.default_rng(4)
    rows, book = rng.integers(-3, 4, (400, 4)).astype(float), rng.integers(-3, 4, (9, 4)).astype(object)
    entry, distance, sums = part_codes.assign(rows, book, True)
    d = ((rows[:, None, :] - book[None].astype(float)) ** 2).sum(axis=2)
    assert np.array_equal(entry, d.argmin(axis=1)) and np.array_equal(distance, d.min(axis=1))
    assert all(sums[e].tolist() == [*rows[entry == e].sum(axis=0), (entry == e).sum()] for e in range(9))


# --- phrases ---------------------------------------------------------------------------------


def expected_phrases(rows, least, longest=5, top=2000):
    n, f, out = Counter(), Counter(), defaultdict(list)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    found = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    inside = {(lang, p[i : i + k]) for (lang, p), c in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if c >= f[lang, p[i : i + k]]}
    for (lang, p), a in found.items():
        if (lang, p) not in inside:
            s, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-s, -a, " ".join(p).encode(), l, r))
    return [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top])]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(9)
    words = ["the", "The", "old", "man", "sea", "É", "x y", "\x1c", "of", "to"]
    made = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  ", ",,"]) for _ in range(rng.randint(0, 60)))) for _ in range(300)]
    rows = [*made, ("en", None), ("en", ""), (None, " . ,\n"), ("de", "of the old man and the sea " * 400), *[("fr", "a b c d e f")] * 30]
    return rows, spark.createDataFrame([(i, t, lang, None, None, 1, 1, 1, 1, 1) for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(4)


@pytest.mark.parametrize("proposing, bits", [(None, 1 << 20), (60, 1 << 20), (10**6, 1 << 20), (8, 1 << 9), (60, 1 << 10)])
def test_phrases_equal_brute_force_whatever_the_sample_proposes(texts, proposing, bits):
    rows, docs = texts
    got = phrases.collocations(docs, least=25, proposing=proposing, filter_bits=bits)
    assert sorted(map(tuple, got.collect())) == sorted(expected_phrases(rows, 25))


def test_phrases_in_small_slices_and_of_no_rows(spark, texts, monkeypatch):
    rows, docs = texts
    one = docs.agg(F.first("doc_id").alias("doc_id"), F.array_join(F.collect_list("text"), ". ").alias("text")).withColumn("lang", F.lit("en"))
    text = one.first().text
    data = text.encode()
    monkeypatch.setattr(phrases, "SLICE", 500)
    parts = list(phrases._cut(data))
    assert b"".join(parts) == data and len(parts) > 30 and all(p[-1:] in [bytes([c]) for c in phrases._STOPS] for p in parts[:-1])
    assert b"".join(phrases._cut(b"a " * 2000)) == b"a " * 2000 and len(list(phrases._cut(b"a " * 2000))) == 2
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = [("en", 0, "", 10**15), ("en", 1, "a", 10**12), ("en", 1, "b", 10**11), ("en", 2, "a b", 10**11)]
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a, **k: spark.createDataFrame(big, "lang string, k int, phrase string, n long"))
    assert tuple(phrases.collocations(None).first()) == ("en", 1, "a b", 10**11, 10**12, 10**11, 10**15, 1000 * 10**15 // 10**12)
