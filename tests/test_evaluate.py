import itertools
import random

from pyspark.sql import functions as F

from tessera.operators import evaluate as EV


def _auc_brute(rows):
    pos = [p for p, y in rows if y == 1]
    neg = [p for p, y in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_auc_with_ties_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice([0.1, 0.2, 0.3, 0.5, 0.7]), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "p double, y int")
    got = EV.auc(df, "p", "y").first()["auc"]
    assert abs(got - _auc_brute(rows)) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.2, 1), (0.4, 1)], "p double, y int")
    assert EV.auc(df, "p", "y").first()["auc"] is None


def test_threshold_tie_nearest_half_then_smaller(spark):
    # accuracy is flat between .46 and .54: ties must go to .50
    rows = [(0.45, 0), (0.55, 1), (0.2, 0), (0.9, 1)]
    df = spark.createDataFrame(rows, "p double, y int")
    scan = EV.threshold_scan(df, "p", "y", 30, 70, 100)
    best = EV.best_threshold(scan, [], "accuracy", "nearest_half").first()
    assert best["threshold"] == 0.5 and best["accuracy"] == 1.0
    first = EV.best_threshold(scan, [], "accuracy", "first").first()
    assert first["threshold"] == 0.46


def test_threshold_scan_matches_loop(spark):
    rng = random.Random(1)
    rows = [(rng.random(), rng.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "p double, y int")
    got = {round(r.threshold, 2): r.accuracy for r in EV.threshold_scan(df, "p", "y", 30, 70, 100).collect()}
    for i in range(30, 71):
        t = i / 100
        want = sum(int(p >= t) == y for p, y in rows) / len(rows)
        assert abs(got[t] - want) < 1e-12


def test_metrics_undefined_are_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, y int")
    m = EV.binary_metrics(df, "p", "y", 0.5).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0 and m["accuracy"] == 1.0


def test_threshold_scan_counts_scores_on_the_grid(spark):
    df = spark.createDataFrame([(i / 100.0, i % 2) for i in range(30, 71)] + [(None, 1)], "p double, y int")
    for r in EV.threshold_scan(df, "p", "y", 30, 70, 100).collect():
        rows = [(i / 100.0, i % 2) for i in range(30, 71)]
        right = sum((p >= r.threshold) == bool(y) for p, y in rows)
        assert abs(r.accuracy - right / len(rows)) < 1e-12, r.threshold


def test_top_rate_cut_edges(spark):
    from tessera.operators.blend import top_rate_cuts

    df = spark.createDataFrame([("f", "a", 0.2), ("f", "b", 0.9), ("f", "c", 0.9), ("f", "d", 0.4)], "family string, id string, p double")
    rows, cuts = top_rate_cuts(df, {"none": 0.0, "half": 0.5, "all": 1.0}, ["family"])
    got = {r.candidate: (r.k, r.threshold) for r in cuts.collect()}
    assert got["none"] == (0, 0.5) and got["all"] == (4, 0.5)
    assert got["half"][0] == 2 and abs(got["half"][1] - 0.65) < 1e-12
    assert {r.id: r.rn for r in rows.collect()} == {"b": 1, "c": 2, "d": 3, "a": 4}


def test_fusion_search_matches_numpy_with_ties(spark):
    import numpy as np

    from tessera.operators import blend as BL

    rng = np.random.default_rng(2)
    rows = [(i, "test" if i % 3 else "train", i // 2 % 2, f, float(rng.integers(1, 8)) / 8) for i in range(120) for f in ("a", "b")]
    df = spark.createDataFrame(rows, "id int, split string, y int, family string, p double")
    grid = [{"a": 0.5, "b": 0.5}, {"a": 1.0, "b": 0.0}]
    views = BL.kind_views(df, ["a", "b"]).withColumn("reference", F.lit(0))
    got = BL.fusion_search(views, grid, ["prob", "logit"], {"r": 0.4, "s": 0.9}).collect()
    assert len(got) == 8
    p = {(r[0], r[3]): r[4] for r in rows}
    for r in got:
        def score(i):
            a, b = p[i, "a"], p[i, "b"]
            if r.kind == "logit":
                a, b = np.log(a / (1 - a)), np.log(b / (1 - b))
            return r.w_a * a + r.w_b * b
        test = np.sort([score(i) for i in range(120) if i % 3])
        t = test[int(np.floor((1 - {"r": 0.4, "s": 0.9}[r.rate_name]) * (len(test) - 1)))]
        assert abs(r.threshold - t) < 1e-12 and r.changed == (test >= r.threshold).sum()


def test_final_iterations_fallbacks(spark):
    from tessera.operators.models import final_iterations

    def rule(best, cap):
        df = spark.createDataFrame([(b,) for b in best], "best_iter int")
        return tuple(final_iterations(df, cap, default=500).first())

    assert rule([100, 101], None) == (100, "valid_fold_mean", 2)  # 100.5 rounds to even
    assert rule([100, None, 0], 80) == (80, "valid_fold_mean", 1)
    assert rule([None], 70) == (70, "tuned_iterations_fallback", 0)
    assert rule([None], None) == (500, "default_config_fallback", 0)
    assert rule([3], 400) == (50, "valid_fold_mean", 1)


def test_fusion_search_makes_no_row_per_candidate(spark):
    import numpy as np

    from tessera.operators import blend as BL

    rng = np.random.default_rng(4)
    rows = [(i, "test" if i % 3 else "train", None if i % 11 == 0 else i // 2 % 2, f, float(rng.random())) for i in range(300) for f in ("a", "b") if (i, f) != (1, "b")]
    df = spark.createDataFrame(rows, "id int, split string, y int, family string, p double")
    grid = [{"a": i / 4, "b": 1 - i / 4} for i in range(5)]
    views = BL.kind_views(df, ["a", "b"]).withColumn("reference", F.when(F.col("id") != 4, F.col("id") % 2))
    out = BL.fusion_search(views, grid, ["prob"], {"r": 0.3})
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    p = {(r[0], r[3]): r[4] for r in rows}
    for r in out.collect():
        score = {i: r.w_a * p[i, "a"] + r.w_b * p[i, "b"] for i in range(300) if i != 1}
        test = sorted(v for i, v in score.items() if i % 3)
        n = len(test) + 1  # the null score of row 1 counts and is the lowest
        assert r.threshold == test[int(np.floor(0.7 * (n - 1))) - 1]
        right = [(score[i] >= r.threshold) == (i // 2 % 2) for i in range(0, 300, 3) if i % 11]
        assert abs(r.accuracy - np.mean(right)) < 1e-12 and abs(r.positive_rate - np.mean([v >= r.threshold for v in test])) < 1e-12
        assert r.changed == sum((v >= r.threshold) != i % 2 for i, v in score.items() if i % 3 and i != 4)
