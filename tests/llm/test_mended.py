"""Hosts, disguised and secret spans, and scores beyond the usual, each against a plain computation."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import pii, quality, queries, secret_scan, topk


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 999)) for _ in range(n))


def test_a_failing_host_goes_and_a_small_one_stays_by_shrinkage(spark, tmp_path):
    rng, rows = random.Random(1), []
    for h in range(30):  # ordinary hosts: one document in ten fails
        rows += [(f"h{h}", words(rng, 10 if i % 10 == 0 else 80)) for i in range(40)]
    rows += [("bad", words(rng, 10 if i % 10 else 80)) for i in range(40)]
    rows += [("small", words(rng, 10)), ("small", words(rng, 80)), (None, words(rng, 80)), (None, None)]
    rows += [("tied", words(rng, 80))] * 3 + [("tied", "")]
    docs = spark.createDataFrame([(i, t, s, 1) for i, (s, t) in enumerate(rows)], "doc_id long, text string, source string, n_lines int").drop("n_lines").withColumn("host_kept", F.lit("x"))
    out = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert len(out) == len(rows)
    assert all(not out[i].kept for i, (s, _) in enumerate(rows) if s == "bad")
    assert all(out[i].kept == (not out[i].base_failed) for i, (s, _) in enumerate(rows) if s != "bad")
    assert sum(out[i].kept for i, (s, _) in enumerate(rows) if s == "small") == 1  # half of it fails, but two documents say little
    docs.drop("host_kept").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cursor = con.execute(queries.ORACLES["op6_quality"])
    got = queries.op6_quality(spark, str(tmp_path)).select(*[d[0] for d in cursor.description])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, cursor.fetchall()))


def test_repeated_lines_count_against_lines(spark):
    rng = random.Random(5)
    long = [words(rng, 40) for _ in range(9)]
    texts = ["\n".join(["read more"] * n + long) for n in (9, 12)]
    out = quality.judge(spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")).orderBy("doc_id").collect()
    assert [(r.n_dup_lines, r.base_failed, r.any_failed) for r in out] == [(8, False, False), (11, False, True)]


def test_long_labels_of_spelled_addresses():
    for n in (5, 60, 90, 5000):
        hidden = f"john at {'a' * n} dot com"
        _, every = pii.find(f"see {hidden} now")
        assert [f"see {hidden} now"[a:b] for _, a, b in every] == [hidden]
    pii.find("john at " + "a" * 200000 + " " + "at b dot " * 20000)


def plain_spans(text):
    """The contract's base shapes of op8, one pattern each."""
    found = []
    found += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def plain_secrets(text):
    """The contract's base shapes of op9."""
    kinds = [
        ("assign", r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m)]
    return [(kinds[k][0], a, b) for a, k, b in sorted(found)]


@pytest.mark.parametrize("which", ["pii", "secrets"])
def test_base_spans_equal_the_plain_patterns(which):
    rng = random.Random(7)
    parts = {
        "pii": ["a", "b.c", "@", "x-y", ".", "com", " ", "-", "+", "1", "255", "256", "(", ")", "4111", "1111", "0", "9", "é", "\n", "%"],
        "secrets": ["password", "PassWd", "token", "api_key", "APIKEY", "secret", "ſecret", "=", ":", " ", '"', "'", "abc", "123", "AKIA", "Z9", "0af3" * 5, "AKIA" + "Q7" * 9, "é", "\n", "_.="],
    }[which]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))
        if which == "pii":
            order = {k: i for i, k in enumerate(pii.KINDS)}
            assert sorted(pii.base_spans(text), key=lambda s: (order[s[0]], s[1])) == sorted(plain_spans(text), key=lambda s: (order[s[0]], s[1])), repr(text)
        else:
            assert [(secret_scan.KINDS[k], a, b) for a, k, b in secret_scan.base_spans(text)] == plain_secrets(text), repr(text)


def ordinary(rng):
    """Runs of key characters that are no secrets: identifiers, paths, dates, versions."""
    part = lambda: "".join(rng.choice(["con", "ti", "re", "er", "la", "men", "to", "us", "in", "al"]) for _ in range(rng.randint(2, 4)))
    return rng.choice([
        lambda: "".join(part().title() for _ in range(4)) + str(rng.randint(1, 99)),
        lambda: f"{part()}/{part()}/{part()}_{rng.randint(1, 9)}/{part().title()}",
        lambda: f"{part()}-{part()}-20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}-{part().title()}",
        lambda: f"{part()}_{part()}_v{rng.randint(1, 9)}_{part().upper()}_{part()}",
    ])()


@pytest.mark.parametrize("share", [0.01, 0.001])
def test_recall_and_false_finds_by_length(spark, share):
    rng, rows, planted = random.Random(11), [], {}
    n = 20_000
    for i in range(n // 10):
        runs = [ordinary(rng) for _ in range(10)]
        rows.append([f"{words(rng, 8)} {r}" for r in runs])
    lengths = (20, 32, 40, 64)
    for j in range(max(8, int(n * share))):
        size, doc = lengths[j % 4], rng.randrange(len(rows))
        key = "".join(rng.choice(secret_scan.ENCODINGS["base62"]) for _ in range(size))
        rows[doc].insert(rng.randrange(10), key)
        planted[key] = size
    texts = [" ".join(r) for r in rows]
    out = secret_scan.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    found = [texts[r.doc_id][int(a) : int(b)] for r in out for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "random"]
    hits = {size: np.mean([key in found for key, s in planted.items() if s == size]) for size in lengths}
    print(share, hits, len(found))
    assert all(hits[size] >= 0.9 for size in (32, 40, 64))
    assert sum(f not in planted for f in found) <= max(1, 0.05 * len(found))
    for r in out[:50]:
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_secrets(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()


def test_scores_of_large_components(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.choice([0, 3, 8, 17]) + rng.random() for _ in range(6)]) for i in range(120)]
    rows += [(500, [1e300] * 6), (501, [1.7e308] * 6), (502, [-1e300] * 6)]
    v = {i: [int(np.floor(256.0 * x)) for x in e] for i, e in rows if all(np.isfinite(256.0 * x) for x in e)}
    got = {}
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    assert set(got) == {0, 50, 100, 500}
    for i, ranks in got.items():
        best = sorted((-clip(sum(a * b for a, b in zip(v[i], w))), j) for j, w in v.items() if j != i)[:5]
        assert [ranks[k + 1] for k in range(5)] == [(j, -s) for s, j in best]


def test_stages_take_clashing_columns_and_order_equal_rows(spark):
    text = " ".join(f"w{i}" for i in range(90))
    rows = [(1, text, "en", s, 0, p) for s, p in (("b", 7), ("a", 8), (None, 9))] + [(2, "x y z " * 30, "en", "a", 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, mix_pass int")
    kept = corpus_pipeline.drop_near_dups(spark, docs, "")
    assert kept.columns == docs.columns
    # nulls come first in each column's turn: lang, source, n_chars, mix_pass
    assert sorted((r.doc_id, r.source, r.mix_pass) for r in kept.collect()) == [(1, None, 9), (2, "a", 1)]
    mixed = corpus_pipeline.mix_sources(spark, kept, "")
    assert mixed.columns == docs.columns
    assert {c: t for c, t in mixed.dtypes}["mix_pass"] != "int"
    out = corpus_pipeline.encode(spark, mixed, "").collect()
    assert {r.doc_id for r in out} <= {1, 2} and all(len(r.ids) == r.n_tokens for r in out) and out
    empty = corpus_pipeline.encode(spark, corpus_pipeline.mix_sources(spark, corpus_pipeline.drop_near_dups(spark, docs.limit(0), ""), ""), "")
    assert empty.count() == 0
