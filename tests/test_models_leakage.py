import random

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tessera.operators import encode as EN
from tessera.operators import evaluate as EV
from tessera.operators import models as MO


def _frame(spark, n=400, seed=3, levels=10):
    rng = random.Random(seed)
    rows = [(f"r{i}", f"k{rng.randrange(levels)}", rng.random(), float(rng.randint(0, 1)), i % 4) for i in range(n)]
    return spark.createDataFrame(rows, "id string, k string, x double, y double, fold int")


def test_run_cv_oof_covers_every_row_once_and_is_deterministic(spark):
    df = _frame(spark)
    stages = MO.feature_pipeline(["x"], ["k"])
    make = lambda f: LogisticRegression(featuresCol="features", labelCol="y", maxIter=20)
    oof, test_mean, _ = MO.run_cv(df, make, stages, "fold", 4, test=df.limit(10), keep=("id", "y"))
    rows = oof.collect()
    assert len(rows) == df.count() and len({r.id for r in rows}) == len(rows)
    assert all(0.0 <= r.p <= 1.0 for r in rows)
    again = {r.id: r.p for r in MO.run_cv(df, make, stages, "fold", 4, keep=("id", "y"))[0].collect()}
    assert all(abs(again[r.id] - r.p) < 1e-12 for r in rows)
    assert test_mean.agg(F.max("members")).first()[0] == 4


def test_label_shuffle_oof_encoding_has_no_signal_but_loo_leaks(spark):
    # labels are random with respect to the category: the out-of-fold encoder scores AUC ~ 0.5;
    # leave-one-out encoding reads the row's own label back: inside every level
    # all positives get a lower value than all negatives, so level + encoding give the label exactly
    df = _frame(spark, n=2000, seed=9, levels=300).withColumn("inner", (F.abs(F.hash("id")) % 5).cast("int"))
    tr = F.col("fold") != 0
    oof = EN.target_encode_oof(df, "k", "y", tr, "inner", smoothing=20.0, name="te")
    loo = EN.target_encode_loo(df, "k", "y", tr, smoothing=20.0, name="te")
    auc_oof = EV.auc(oof.filter(tr), "te", "y").first()["auc"]
    assert abs(auc_oof - 0.5) < 0.06
    per = loo.filter(tr).groupBy("k").agg(
        F.max(F.when(F.col("y") == 1, F.col("te"))).alias("pos_max"), F.min(F.when(F.col("y") == 0, F.col("te"))).alias("neg_min"))
    both = per.filter(F.col("pos_max").isNotNull() & F.col("neg_min").isNotNull())
    assert both.count() > 100
    assert both.filter(F.col("pos_max") >= F.col("neg_min")).count() == 0
    oof_per = oof.filter(tr).groupBy("k").agg(
        F.max(F.when(F.col("y") == 1, F.col("te"))).alias("pos_max"), F.min(F.when(F.col("y") == 0, F.col("te"))).alias("neg_min"))
    assert oof_per.filter(F.col("pos_max") >= F.col("neg_min")).count() > 0  # no such separation out of fold
