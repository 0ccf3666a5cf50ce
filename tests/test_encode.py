import random

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import encode as EN


def test_target_encode_unseen_null_single(spark):
    rows = [("tr", "a", 1), ("tr", "a", 0), ("tr", None, 1), ("tr", "s", 1), ("te", "a", None), ("te", "zz", None), ("te", None, None)]
    df = spark.createDataFrame(rows, "split string, k string, y int")
    out = EN.target_encode(df, "k", "y", F.col("split") == "tr", smoothing=2.0).collect()
    g = 3 / 4
    enc = {(r.split, r.k): r.te_k for r in out}
    assert abs(enc[("te", "a")] - (1 + g * 2) / (2 + 2)) < 1e-12
    assert abs(enc[("te", "zz")] - g) < 1e-12          # unseen -> prior
    assert abs(enc[("te", None)] - (1 + g * 2) / (1 + 2)) < 1e-12  # null is a level
    assert abs(enc[("tr", "s")] - (1 + g * 2) / (1 + 2)) < 1e-12   # level of one row


def test_target_encode_one_class(spark):
    df = spark.createDataFrame([("tr", "a", 1), ("tr", "b", 1), ("te", "c", None)], "split string, k string, y int")
    vals = [r.te_k for r in EN.target_encode(df, "k", "y", F.col("split") == "tr").collect()]
    assert all(abs(v - 1.0) < 1e-12 for v in vals)


def test_oof_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"r{i}", "tr", rng.choice("abcd"), rng.randint(0, 1), rng.randint(0, 2)) for i in range(60)]
    rows += [(f"t{i}", "te", rng.choice("abcde"), None, 0) for i in range(10)]
    df = spark.createDataFrame(rows, "id string, split string, k string, y int, fold int")
    got = {r.id: r.te_k for r in EN.target_encode_oof(df, "k", "y", F.col("split") == "tr", "fold", smoothing=5.0).collect()}
    train = [r for r in rows if r[1] == "tr"]
    gall = sum(r[3] for r in train) / len(train)
    for rid, split, k, y, f in rows:
        if split == "tr":
            other = [r for r in train if r[4] != f]
            g = sum(r[3] for r in other) / len(other)
            lv = [r[3] for r in other if r[2] == k]
            want = (sum(lv) + g * 5.0) / (len(lv) + 5.0) if lv else gall
        else:
            lv = [r[3] for r in train if r[2] == k]
            want = (sum(lv) + gall * 5.0) / (len(lv) + 5.0) if lv else gall
        assert abs(got[rid] - want) < 1e-12, rid


def test_tfidf_norm_and_whole_text(spark):
    df = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta gamma " + "delta " * 500)], "doc_id long, text string")
    w = EN.tfidf(df, "doc_id", "text").collect()
    norms = {}
    for r in w:
        norms[r.doc_id] = norms.get(r.doc_id, 0.0) + r.weight ** 2
    assert all(abs(v - 1.0) < 1e-9 for v in norms.values())
    assert any(r.term == "delta" for r in w)  # tokens far into the text are kept


def test_tfidf_svd_keeps_documents_without_terms(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (3, "?"), (4, None), (5, "aa cc dd")], "doc_id long, text string")
    out = {r.doc_id: r for r in EN.tfidf_svd(EN.tfidf(docs, "doc_id", "text"), "doc_id", docs, k=2).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert out[3].svd_0 == out[4].svd_0 == 0.0 and out[1].svd_0 != 0.0


def test_tfidf_fits_on_the_chosen_rows_only(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "bb cc"), (3, "zz bb")], "doc_id long, text string")
    terms = {(r.doc_id, r.term) for r in EN.tfidf(docs, "doc_id", "text", fit_on=F.col("doc_id") < 3).collect()}
    assert (3, "bb") in terms and (3, "zz") not in terms


def test_tfidf_svd_reads_the_documents_once_for_all_components(spark):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(f"t{j:03d}" for j in rng.zipf(1.3, 40) % 130)) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    weights = EN.tfidf(docs, "doc_id", "text").cache()
    cells = weights.collect()
    terms = sorted({c.term for c in cells})
    dense = np.zeros((300, len(terms)))
    for c in cells:
        dense[c.doc_id, terms.index(c.term)] = c.weight
    v = np.linalg.svd(dense, full_matrices=False)[2][:3]
    v *= np.sign(v[np.arange(3), np.abs(v).argmax(axis=1)])[:, None]
    spark.sparkContext.setJobGroup("svd", "svd")
    out = EN.tfidf_svd(weights, "doc_id", docs, k=3)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("svd")
    got = np.array([[r.svd_0, r.svd_1, r.svd_2] for r in out.orderBy("doc_id").collect()])
    assert len(terms) >= 100 and np.abs(got - dense @ v.T).max() < 1e-9
    assert len(jobs) < 15
