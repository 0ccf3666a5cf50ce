import pytest
from pyspark.sql import functions as F

from tessera.operators import contracts as CT
from tessera.operators import folds as FO


def _frame(spark):
    rows = [(f"{g:03d}_{m}", f"{g:03d}", (g * 7 + m) % 3 == 0) for g in range(60) for m in range(1 + g % 4)]
    return spark.createDataFrame([(i, g, int(y)) for i, g, y in rows], "id string, g string, y int")


def test_group_folds_disjoint_and_complete(spark):
    df = _frame(spark)
    out = FO.stratified_group_kfold(df, "g", "y", 5)
    assert out.count() == df.count()
    assert out.groupBy("g").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    assert sorted(r.fold for r in out.select("fold").distinct().collect()) == [0, 1, 2, 3, 4]


def test_stratified_folds_balance_and_determinism(spark):
    df = _frame(spark)
    a = FO.stratified_kfold(df, "id", "y", 5, seed=1)
    b = FO.stratified_kfold(df, "id", "y", 5, seed=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    per = a.groupBy("fold").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    assert max(r.pos for r in per) - min(r.pos for r in per) <= 1
    assert max(r.n for r in per) - min(r.n for r in per) <= 2


def test_holdout_exact_counts(spark):
    df = _frame(spark)
    out = FO.stratified_holdout(df, "id", "y", 0.2)
    import math

    for y in (0, 1):
        n = df.filter(F.col("y") == y).count()
        v = out.filter((F.col("y") == y) & (F.col("holdout") == "valid")).count()
        assert v == math.ceil(0.2 * n)


def test_contracts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", None)], "id string, v int")
    rep = {r.check: r.violations for r in CT.frame_contract(df, "id", ["id", "v", "missing"]).collect()}
    assert rep["duplicate_ids"] == 1 and rep["missing_columns"] == 1 and rep["null_cells"] == 1 and rep["empty_ids"] == 1
    with pytest.raises(ValueError):
        CT.enforce(CT.frame_contract(df, "id", ["id", "v"]))
    t = spark.createDataFrame([("x", 1, 0)], "id string, v int, y int")
    rep = {r.check: r.violations for r in CT.test_schema_contract(t, "id", "y", ["v", "id"], strict_order=True).collect()}
    assert rep["label_present"] == 1 and rep["wrong_order"] == 1
    with pytest.raises(ValueError):
        CT.align_columns(t, ["id", "extra"])


def test_leak_guard():
    with pytest.raises(ValueError):
        FO.assert_no_leak(["age", "y"], ["y", "id"])
    FO.assert_no_leak(["age"], ["y", "id"])


def test_null_ids_are_no_duplicates(spark):
    from tessera.operators.contracts import duplicate_count

    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "id string")
    assert df.agg(duplicate_count("id")).first()[0] == 1
