import random

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators.core import ordered_index, running_totals


def test_ordered_index_groups_and_null_key(spark):
    rows = [("a", 3.0, "x1"), ("a", 1.0, "x2"), (None, 5.0, "x3"), (None, 2.0, "x4"), ("b", 9.0, "x5")]
    df = spark.createDataFrame(rows, "g string, v double, id string")
    for many in (False, True):
        got = {r.id: (r.rn, r.n) for r in ordered_index(df, ["v", "id"], by=["g"], name="rn", count_name="n",
                                                        num_partitions=3, many_groups=many).collect()}
        assert got == {"x2": (1, 2), "x1": (2, 2), "x4": (1, 2), "x3": (2, 2), "x5": (1, 1)}


def test_running_totals_match_python(spark):
    rng = random.Random(5)
    rows = [(rng.choice("pq"), i, float(rng.randint(0, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    got = {(r.g, r.k): r.cum_v for r in running_totals(df, ["k"], ["g"], ["v"], num_partitions=7).collect()}
    for g in "pq":
        acc = 0.0
        for _, k, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            acc += v
            assert got[(g, k)] == acc


def test_univariate_accuracy_brute_force(spark):
    rng = random.Random(11)
    rows = [(float(rng.randint(0, 20)), rng.randint(0, 1), i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "x double, y int, fold int")
    got = FE.univariate_cv_accuracy(df, {"raw": F.col("x")}, "y", "fold").first()["cv_accuracy"]
    accs = []
    for f in range(3):
        tr = [r for r in rows if r[2] != f]
        va = [r for r in rows if r[2] == f]
        n = len(tr)
        cov = sum(x * y for x, y, _ in tr) - sum(x for x, _, _ in tr) * sum(y for _, y, _ in tr) / n
        d = (cov > 0) - (cov < 0)
        xs = [d * x for x, _, _ in va]
        best = max(sum((xp > t) == (y == 1) for xp, (_, y, _) in zip(xs, va)) for t in xs + [float("inf")])
        accs.append(best / len(va))
    assert abs(got - sum(accs) / 3) < 1e-12


def test_drop_materialized(spark):
    from tessera.operators import core

    df = core.materialize(spark.range(10), "probe")
    assert df.count() == 10
    assert core.drop_materialized(spark) >= 1
    assert core.MATERIALIZED == []
