"""Model fits and scoring through Spark ML.

Fitting is Spark ML's distributed training; out-of-fold scoring is a loop
over folds around ``fit`` only (k model fits), while every feature statistic
is fitted per fold in one job beforehand (see :mod:`tessera.operators.folds`).
Scores are kept as a long table ``(id, family, fold, seed, p)`` so that
bagging, blending and evaluation are aggregates, never positional joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.core import FILE_ROWS, attach_row, fit_tasks, materialize


def pseudo_label_rows(
    scored: DataFrame, proba: str, label: str, hi: float = 0.98, lo: float = 0.02, min_rows: int = 100
) -> DataFrame:
    """Confident rows with their predicted label; no rows at all when fewer than ``min_rows``.

    The count is a one-row aggregate attached to the rows, so the rule stays
    lazy and distributed (no driver round trip).
    """
    conf = scored.filter((F.col(proba) >= hi) | (F.col(proba) <= lo))
    n = conf.agg(F.count(F.lit(1)).alias("__cnt"))
    out = attach_row(conf, n).filter(F.col("__cnt") >= min_rows).drop("__cnt")
    return out.withColumn(label, (F.col(proba) >= hi).cast("int"))


# ------------------------------------------------------------------ fits (L)

from collections.abc import Callable, Sequence  # noqa: E402
from multiprocessing.pool import ThreadPool  # noqa: E402

from pyspark import inheritable_thread_target  # noqa: E402
from pyspark.ml import Pipeline, PipelineModel  # noqa: E402
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier  # noqa: E402
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> list:
    """Stages: train-fit median imputation, indexers (unseen kept then dropped), one-hot, assembler."""
    stages = [Imputer(inputCols=list(numeric), outputCols=[f"{c}__imp" for c in numeric], strategy="median")]
    if categorical:  # one pass for all of them
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__idx" for c in categorical], handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=[f"{c}__ohe" for c in categorical]))
    stages.append(VectorAssembler(inputCols=[f"{c}__imp" for c in numeric] + [f"{c}__ohe" for c in categorical], outputCol=out))
    return stages


def slot_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the assembled vector slots, read from the column's ML attribute metadata."""
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [n for _, n in slots]


def probability(df: DataFrame, col: str = "probability", name: str = "p") -> DataFrame:
    """P(class 1) as a double column."""
    return df.withColumn(name, vector_to_array(col).getItem(1))


def logistic(label: str = "y", c: float = 1.0, n: int = 1, max_iter: int = 100) -> LogisticRegression:
    """L1: L2 logistic regression with sklearn's C: regParam = 1 / (C n), no standardisation."""
    return LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter)


def fit(est, df: DataFrame):
    """``est`` fitted on ``df`` in tasks of bounded rows (a table written with ``file_rows``)."""
    with fit_tasks(df):
        return est.fit(df)


def prepared(stages: list, df: DataFrame, keep: Sequence[str], out: str = "features") -> tuple[PipelineModel, DataFrame]:
    """The feature stages fitted on ``df`` and its rows with their features, written once for several fits."""
    prep = Pipeline(stages=stages).fit(df)
    return prep, materialize(prep.transform(df).select(*keep, out), "prepared", FILE_ROWS)


def member_scores(df: DataFrame, models: Sequence[tuple[int, object]], keep: Sequence[str]) -> DataFrame:
    """Scores of several models (seed, model) of the same rows, which are read once: ``keep..., seed, p``."""
    scored, members = df, []
    for i, (seed, model) in enumerate(models):
        scored = probability(model.transform(scored), name=f"__p{i}").drop("rawPrediction", "probability", "prediction")
        members.append(F.struct(F.lit(seed).alias("seed"), F.col(f"__p{i}").alias("p")))
    long = scored.select(*keep, F.explode(F.array(*members)).alias("__m"))
    return long.select(*keep, "__m.seed", "__m.p")


def run_cv(
    df: DataFrame,
    make: Callable[[int], object],
    stages: list,
    fold: str,
    k: int,
    label: str = "y",
    test: DataFrame | None = None,
    seed: int = 0,
    keep: Sequence[str] = ("id",),
) -> tuple[DataFrame, DataFrame | None, list[PipelineModel]]:
    """Out-of-fold scores (keep..., fold, seed, p) and the mean test score over fold models.

    The loop is around ``fit`` only (k model fits); data preparation is done
    once by the caller with the fold as a column.
    """
    oof, tests, models = None, None, []
    for f in range(k):
        est = make(f)
        model = fit(Pipeline(stages=[*stages, est]), df.filter(F.col(fold) != f))
        models.append(model)
        scored = probability(model.transform(df.filter(F.col(fold) == f)))
        part = scored.select(*keep, F.lit(f).alias("fold"), F.lit(seed).alias("seed"), "p")
        oof = part if oof is None else oof.unionByName(part)
        if test is not None:
            t = probability(model.transform(test)).select(*keep, F.lit(f).alias("fold"), F.lit(seed).alias("seed"), "p")
            tests = t if tests is None else tests.unionByName(t)
    test_mean = tests.groupBy(*keep).agg(F.avg("p").alias("p"), F.count(F.lit(1)).alias("members")) if tests is not None else None
    return oof, test_mean, models


def grid_cv(df: DataFrame, stages: list, est, grid: Sequence[dict], evaluator, fold: str, k: int, label: str = "y", parallelism: int = 2) -> tuple[list[float], PipelineModel]:
    """What ``CrossValidator`` does on a fold column: the mean fold metric of each map of ``grid`` and the best one's fit on all rows.

    A parameter map does not change the feature stages, so they are fitted once for a fold and not once for each map, and
    the features are written once: fits and scores of all maps read them.
    """
    run = inheritable_thread_target(df.sparkSession)

    def fits(x, maps):
        candidates = est.fitMultiple(x, maps)  # hands out one fit a call, to several threads

        def one(_):
            i, model = next(candidates)
            return i, model

        with fit_tasks(x, 5), ThreadPool(min(parallelism, len(maps))) as pool:
            return [m for _, m in sorted(pool.map(run(one), range(len(maps))), key=lambda f: f[0])]

    sums = [0.0] * len(grid)
    for f in range(k):
        prep, x = prepared(stages, df.where(F.col(fold) != f), (label,))
        valid = materialize(prep.transform(df.where(F.col(fold) == f)).select(label, "features"), "valid", FILE_ROWS)
        models = fits(x, grid)
        with fit_tasks(valid, 5), ThreadPool(min(parallelism, len(grid))) as pool:
            scores = pool.map(run(lambda m: evaluator.evaluate(m.transform(valid))), models)
        sums = [a + b for a, b in zip(sums, scores)]
    means = [a / k for a in sums]
    best = (max if evaluator.isLargerBetter() else min)(range(len(grid)), key=lambda i: means[i])
    prep, x = prepared(stages, df, (label,))
    return means, PipelineModel([*prep.stages, *fits(x, [grid[best]])])


def bag(scores: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Members (seeds x folds) averaged per key: sum / count."""
    return scores.groupBy(*keys).agg((F.sum("p") / F.count("p")).alias("p"), F.count("p").alias("members"))


def final_iterations(best: DataFrame, cap: int | None, default: int, floor: int = 50) -> DataFrame:
    """Trees for the final fit: max(floor, min(mean fold best rounded half to even, cap)).

    Fold bests below 1 or null do not count; without any, the cap stands in, and without a cap ``default``.
    """
    mean = F.bround(F.avg(F.when(F.col("best_iter") >= 1, F.col("best_iter"))), 0).cast("int")
    top = F.lit(cap).cast("int")
    taken = F.coalesce(mean, top, F.lit(default))
    source = F.when(mean.isNotNull(), "valid_fold_mean").when(top.isNotNull(), "tuned_iterations_fallback").otherwise("default_config_fallback")
    return best.agg(F.greatest(F.lit(floor), F.least(taken, top)).alias("final_iterations"), source.alias("source"),
                    F.count_if(F.col("best_iter") >= 1).alias("valid_folds"))


def importance_table(importances: DataFrame) -> DataFrame:
    """Mean importance over members (``model, feature, importance, original_order``), divided by each model's
    largest mean; rank by mean, then original order.  A row per model and feature."""
    t = importances.groupBy("model", "feature").agg(
        F.avg("importance").alias("importance"), F.min("original_order").alias("original_order"), F.count(F.lit(1)).alias("members"))
    own = Window.partitionBy("model")
    t = t.withColumn("normalised", F.try_divide(F.col("importance"), F.max("importance").over(own)))
    return t.withColumn("rank", F.row_number().over(own.orderBy(F.desc("importance"), "original_order")))
