"""Fits read written tables in tasks of bounded rows; members share their feature stages and their scan."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tessera.operators import models as MO
from tessera.operators.core import fit_tasks, materialize

LEAST = "spark.sql.files.minPartitionNum"


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(40_000).withColumns({"x": F.rand(3), "home": F.when(F.col("id") % 3 == 0, "a").otherwise("b"), "fold": (F.col("id") % 2).cast("int")})
    df = df.withColumn("y", (F.col("x") + F.when(F.col("home") == "a", 0.3).otherwise(0.0) > 0.7).cast("double"))
    return materialize(df.repartition(2), "rows", 500)


def most(df):
    return max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())


def test_a_task_of_a_fit_reads_few_files(spark, rows):
    """Rows of a task are bounded by the files of a task, not by the size of the table."""
    assert len(rows.inputFiles()) == 80
    with fit_tasks(rows, 1):
        assert most(rows.select("*")) <= 2 * 500
        assert most(rows.where("fold = 0").select("*")) <= 2 * 500
    assert spark.conf.get(LEAST, None) is None


def test_the_setting_comes_back(spark, rows):
    spark.conf.set(LEAST, "5")
    try:
        with pytest.raises(ValueError), fit_tasks(rows):
            raise ValueError
        assert spark.conf.get(LEAST, None) == "5"
    finally:
        spark.conf.unset(LEAST)


def test_fit_reads_in_bounded_tasks(spark, rows):
    seen = []

    class Fit:
        def fit(self, df):
            seen.append(spark.conf.get(LEAST, None))

    MO.fit(Fit(), rows)
    assert int(seen[0]) >= 80 // 3


def written_files(monkeypatch):
    """``file_rows`` of the tables that are written, by name."""
    from tessera.operators import core

    seen, write = {}, core.materialize

    def noted(df, name="frame", file_rows=None):
        seen[name] = file_rows
        return write(df, name, file_rows)

    return seen, noted


def test_tables_of_fits_have_bounded_files(spark, monkeypatch):
    from tessera.plans import catalog_models as CM

    seen, noted = written_files(monkeypatch)
    monkeypatch.setattr(CM, "materialize", noted)
    assert CM.l_nominal_trees(spark, "/root/testdata/sf0.001").count() == 9
    assert seen["folded"] and seen["nominal"]


def test_members_share_stages_and_scan(spark, rows):
    """Scores of members on one scan are those of whole pipelines, and the bag averages them."""
    prep, x = MO.prepared(MO.feature_pipeline(["x"], ["home"]), rows.where("fold = 0"), ("y",))
    models = [(s, MO.fit(RandomForestClassifier(labelCol="y", numTrees=3, maxDepth=3, seed=s), x)) for s in (1, 2)]
    valid = rows.where("fold = 1 and id < 2000")
    scores = MO.member_scores(prep.transform(valid), models, ("id",))
    apart = [MO.probability(m.transform(prep.transform(valid))).select("id", F.lit(s).alias("seed"), "p") for s, m in models]
    assert sorted(scores.collect()) == sorted(apart[0].unionByName(apart[1]).collect())
    assert len(valid.inputFiles()) == len(scores.inputFiles())
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert MO.bag(scores).where("members = 2").count() == 1000


def test_forest_check_fits_its_stages_once_a_fit(spark, monkeypatch):
    """The two forests of a fit share their feature stages: one for the check, one for the refit."""
    from tessera.plans import catalog_models as CM

    calls, stages = [], CM._stages
    monkeypatch.setattr(CM, "_stages", lambda *a: calls.append(1) or stages(*a))
    row = CM.l_forest_check(spark, "/root/testdata/sf0.001").first()
    assert len(calls) == 2 and row.members == 2 and row.test_rows > 0


def test_grid_cv_is_cross_validation_with_stages_fitted_once(spark, rows, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml import Pipeline
    from pyspark.ml.tuning import CrossValidator

    df = rows.where("id < 8000")
    lr = LogisticRegression(labelCol="y", maxIter=20)
    grid = [{lr.regParam: r, lr.elasticNetParam: e} for r, e in ((0.5, 1.0), (0.001, 0.0), (0.05, 0.5))]
    evaluator = BinaryClassificationEvaluator(labelCol="y")
    stages = MO.feature_pipeline(["x"], ["home"])
    cv = CrossValidator(estimator=Pipeline(stages=[*stages, lr]), estimatorParamMaps=grid, evaluator=evaluator, foldCol="fold", numFolds=2).fit(df)
    preps, prepared = [], MO.prepared
    monkeypatch.setattr(MO, "prepared", lambda *a: preps.append(1) or prepared(*a))
    means, best = MO.grid_cv(df, stages, lr, grid, evaluator, "fold", 2)
    assert means == pytest.approx(cv.avgMetrics, abs=1e-6)
    assert best.stages[-1].coefficients.toArray() == pytest.approx(cv.bestModel.stages[-1].coefficients.toArray(), abs=1e-5)
    assert len(preps) == 3  # a fold each and the final fit
    assert spark.conf.get(LEAST, None) is None


def test_search_reads_a_table_of_bounded_files(spark, monkeypatch):
    from tessera.operators import models
    from tessera.plans import catalog_models as CM

    seen, noted = written_files(monkeypatch)
    monkeypatch.setattr(models, "materialize", noted)
    monkeypatch.setattr(CM, "materialize", noted)
    assert CM.l_tree_search(spark, "/root/testdata/sf0.001").count() == 4
    assert seen and all(seen.values())
