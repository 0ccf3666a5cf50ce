"""Queries of SURVEY §2.L (model fit and scoring through Spark ML).

Model fits are checked by invariants (rows, ranges, determinism), not by a
DuckDB oracle.  Inputs: fixture W's train rows with a hash fold; features are
imputed numerics plus one-hot categories, fitted inside each fold's pipeline.
"""

from __future__ import annotations

import math
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import evaluate as EV
from tessera.operators import folds as FO
from tessera.operators import members as ME
from tessera.operators import models as MO
from tessera.operators.core import FILE_ROWS, MATERIALIZED, attach_row, materialize
from tessera.plans.registry import register
from tessera.plans.sqlparts import keyed
from tessera.plans.util import rounded
from tessera.session import ensure_checkpoint_dir
from tessera.sources.fixtures import AMOUNTS, predictions, wide

K = 3
NUMERIC = ["age", *AMOUNTS]
CATEGORICAL = ["home", "vip", "flag"]


def _frame(spark, sf_dir):
    w = wide(spark, sf_dir).select("id", "split", "y", *NUMERIC, *CATEGORICAL)
    w = w.withColumn("fold", C.hash_bucket(K, "id", seed=3)).withColumn("y", F.col("y").cast("double"))
    w = w.fillna("Unknown", subset=CATEGORICAL)
    w = materialize(w, "model-input", FILE_ROWS)  # several fits read it: compute the joins once
    return w.filter(F.col("split") == "train"), w.filter(F.col("split") == "test")


def _stages(numeric=NUMERIC, categorical=CATEGORICAL):
    return MO.feature_pipeline(numeric, categorical)


@register("l_logistic", "L1")
def l_logistic(spark, sf_dir):
    """L1: L2 logistic regression (C = 1): coefficient and odds-ratio table sorted by |coefficient|."""
    train, _ = _frame(spark, sf_dir)
    n = train.count()
    model = Pipeline(stages=[*_stages(), MO.logistic("y", 1.0, n)]).fit(train)
    names = MO.slot_names(model.transform(train.limit(1)))
    coefs = model.stages[-1].coefficients.toArray().tolist()
    rows = [(nm, float(c)) for nm, c in zip(names, coefs)] + [("intercept", float(model.stages[-1].intercept))]
    t = spark.createDataFrame(rows, "feature string, coef double")
    t = t.withColumn("odds_ratio", F.exp("coef")).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc(F.abs("coef")), "feature")))  # one row per feature
    return rounded(t)


@register("l_forest_members", "L2")
def l_forest_members(spark, sf_dir):
    """L2: two random forests (different seeds) fitted on train; test probability = member mean."""
    train, test = _frame(spark, sf_dir)
    prep, x = MO.prepared(_stages(), train, ("y",))
    models = [(seed, MO.fit(RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=20, maxDepth=5, seed=seed), x)) for seed in (1, 2)]
    return rounded(MO.bag(MO.member_scores(prep.transform(test), models, ("id",))))


@register("l_forest_tuned_cv", "L3")
def l_forest_tuned_cv(spark, sf_dir):
    """L3: class-balanced forest (weight column), k-fold accuracy at the tuned threshold 0.51."""
    train, _ = _frame(spark, sf_dir)
    pos = train.agg(F.avg("y").alias("r")).first()["r"]
    train = train.withColumn("w", F.when(F.col("y") == 1, 0.5 / pos).otherwise(0.5 / (1 - pos)))
    oof, _, _ = MO.run_cv(
        train, lambda f: RandomForestClassifier(featuresCol="features", labelCol="y", weightCol="w", numTrees=20,
                                                maxDepth=5, seed=f),
        _stages(), "fold", K, keep=("id", "y"))
    return rounded(EV.binary_metrics(oof, "p", "y", 0.51, by=["fold"]).select("fold", "accuracy", "f1", "n"))


@register("l_gbt_cv", "L4-L8/L10/L11/L13")
def l_gbt_cv(spark, sf_dir):
    """Boosted trees per fold with early stopping on an inner validation slice;
    out-of-fold scores, fold metrics, trees used per fold, and the mean test score of the fold models."""
    train, test = _frame(spark, sf_dir)
    train = train.withColumn("is_val", C.hash_bucket(10, "id", seed=5) == 0)

    def make(f):
        return GBTClassifier(featuresCol="features", labelCol="y", maxIter=20, maxDepth=3, seed=f,
                             validationIndicatorCol="is_val", validationTol=0.01, stepSize=0.2)

    oof, test_mean, models = MO.run_cv(train, make, _stages(), "fold", K, test=test, keep=("id", "y"))
    trees = spark.createDataFrame([(f, m.stages[-1].getNumTrees) for f, m in enumerate(models)], "fold int, trees int")
    oof = materialize(oof, "oof")  # scored once for both tables
    m = EV.binary_metrics(oof, "p", "y", 0.5, by=["fold"]).join(EV.auc(oof, "p", "y", by=["fold"]), "fold")
    out = m.join(trees, "fold").select("fold", "accuracy", "auc", "logloss", "trees", "n")
    test_n = test_mean.agg(F.count(F.lit(1)).alias("test_rows"), F.avg("p").alias("test_mean_p"))
    return rounded(attach_row(out, test_n))


@register("l_iteration_rule", "L9")
def l_iteration_rule(spark, sf_dir):
    """Trees of the final fit from the fold best iterations: max(50, min(mean rounded half to even, cap of 60))."""
    train, _ = _frame(spark, sf_dir)
    train = train.withColumn("is_val", C.hash_bucket(10, "id", seed=5) == 0)
    best = []
    for f in range(K):
        gbt = GBTClassifier(featuresCol="features", labelCol="y", maxIter=60, maxDepth=3, seed=f,
                            validationIndicatorCol="is_val", validationTol=0.01)
        model = MO.fit(Pipeline(stages=[*_stages(), gbt]), train.filter(F.col("fold") != f))
        best.append((f, model.stages[-1].getNumTrees))
    return MO.final_iterations(spark.createDataFrame(best, "fold int, best_iter int"), cap=60, default=60)


_BESTS = "CAST(CASE WHEN p < 0.1 THEN NULL WHEN p < 0.2 THEN 0 ELSE floor(p * 200) END AS INTEGER)"


@register(
    "l_iteration_table", "L9",
    sql=f"""
    WITH b AS (SELECT family, {_BESTS} AS best_iter FROM p WHERE id LIKE '%1_1'),
    m AS (SELECT family, CAST(round_even(avg(best_iter) FILTER (best_iter >= 1), 0) AS INTEGER) AS mean, count(*) FILTER (best_iter >= 1) AS valid_folds FROM b GROUP BY family),
    c AS (SELECT * FROM (VALUES ('f1', 80, 120), ('f2', NULL, 120), ('f3', 300, 120), ('f4', 30, 120)) t(family, cap, fallback))
    SELECT family, greatest(50, least(coalesce(mean, cap, fallback), cap)) AS final_iterations,
           CASE WHEN mean IS NOT NULL THEN 'valid_fold_mean' WHEN cap IS NOT NULL THEN 'tuned_iterations_fallback' ELSE 'default_config_fallback' END AS source, valid_folds
    FROM m JOIN c USING (family)""",
    fixtures=("p",),
)
def l_iteration_table(spark, sf_dir):
    """The rule alone on given best iterations (from scores): four families with caps below, above and without."""
    best = predictions(spark, sf_dir).where("id like '%1_1'").withColumn("best_iter", F.expr(_BESTS))
    out = None
    for family, cap in (("f1", 80), ("f2", None), ("f3", 300), ("f4", 30)):
        part = MO.final_iterations(best.where(F.col("family") == family), cap=cap, default=120).withColumn("family", F.lit(family))
        out = part if out is None else out.unionByName(part)
    return out.select("family", "final_iterations", "source", "valid_folds")


# --- members over groups, seeds and folds -------------------------------------------------------

_ROLES = {"surname": "surname", "group": "group_id", "number": "num", "age": "age", "total": "total", "flag": "flag"}
_SMALL = {"maxIter": 8, "maxDepth": 3, "stepSize": 0.2, "validationTol": 0.001}


def _folded(spark, sf_dir):
    """Train and test rows with keys, row folds and group folds (null on test rows) and inner folds."""
    w = keyed(wide(spark, sf_dir))
    train = F.col("split") == "train"
    w = w.withColumns({"fold_row": F.when(train, C.hash_bucket(K, "id", seed=3)), "fold_group": F.when(train, C.hash_bucket(K, "group_id", seed=3)), "inner": C.hash_bucket(5, "id", seed=0)})
    w = w.withColumn("y", F.when(train, F.col("y")).cast("double"))
    return materialize(w.drop("split"), "folded", FILE_ROWS)


def _member_matrix(spark, sf_dir, mode="oof"):
    spec = ME.StageSpec("members", "row", numeric=tuple(NUMERIC), nominal=("home", "vip", "flag"), encoder=mode, encoded=("dest", "deck"), refit=True)
    return ME.stage_matrix(_folded(spark, sf_dir), spec, K, _ROLES)


_GROUPS = [ME.MemberGroup("shallow", {**_SMALL, "maxDepth": 2}, (1, 2)), ME.MemberGroup("deep", {**_SMALL, "maxDepth": 4, "subsamplingRate": 0.8}, (1, 2))]


@register("l_member_plan", "L4/L8")
def l_member_plan(spark, sf_dir):
    """L4: members over 2 groups x 2 seeds x folds on one matrix with early stopping: trees, rows, accuracy, and the groups chosen for the blend."""
    scores, trees = ME.fit_members(_member_matrix(spark, sf_dir), _GROUPS, range(K))
    chosen = ME.select_groups(ME.group_scores(scores), [g.name for g in _GROUPS])
    m = EV.binary_metrics(scores.where("role = 'valid'"), "p", "y", 0.5, by=["group", "seed", "fold"]).select("group", "seed", "fold", "n", "accuracy")
    t = spark.createDataFrame(trees, "group string, seed int, fold int, trees int")
    tests = scores.where("role = 'test'").groupBy("group", "seed", "fold").agg(F.count(F.lit(1)).alias("n_test"))
    keys = ["group", "seed", "fold"]
    return rounded(m.join(t, keys).join(tests, keys).withColumn("chosen", F.col("group").isin(chosen)))


@register("l_member_scores", "L4/L13")
def l_member_scores(spark, sf_dir):
    """The mean member score of every train row (its own fold, over seeds and groups) and test row (over all members)."""
    scores, _ = ME.fit_members(_member_matrix(spark, sf_dir), _GROUPS, range(K))
    return rounded(scores.groupBy("id", "role").agg(F.avg("p").alias("p"), F.count(F.lit(1)).alias("members")))


@register("l_nominal_trees", "L5")
def l_nominal_trees(spark, sf_dir):
    """Trees on nominal slots (sets of levels) without a holdout: gain importance of every slot."""
    w = _folded(spark, sf_dir).where("fold_row is not null").withColumns({"fit_fold": F.lit(0), "role": F.lit("train")})
    slots = [*NUMERIC, "home", "vip", "flag"]
    x = materialize(ME.assemble(w, NUMERIC, ["home", "vip", "flag"]).select("id", "y", "fit_fold", "role", "features"), "nominal", FILE_ROWS)
    model = MO.fit(GBTClassifier(featuresCol="features", labelCol="y", maxIter=8, maxDepth=3, seed=1), x)
    rows = [("gbt", n, float(v), i) for i, (n, v) in enumerate(zip(slots, model.featureImportances.toArray().tolist()))]
    return rounded(MO.importance_table(spark.createDataFrame(rows, "model string, feature string, importance double, original_order int")))


@register("l_seed_ensemble", "L6")
def l_seed_ensemble(spark, sf_dir):
    """Folds with early stopping give the mean number of trees; three seeds are fitted with it (100 at least) on all train rows and averaged."""
    matrix = _member_matrix(spark, sf_dir)
    _, trees = ME.fit_members(matrix.where("role <> 'test'"), [ME.MemberGroup("cv", {**_SMALL, "maxIter": 5000}, (1,))], range(K))  # the stop decides
    n = ME.final_tree_count(trees)
    scores = ME.final_members(matrix, {k: v for k, v in _SMALL.items() if k != "maxIter"}, n, (1, 2, 3))
    return rounded(MO.bag(scores).withColumn("trees", F.lit(n)))


@register("l_encoded_trees", "L7")
def l_encoded_trees(spark, sf_dir):
    """Trees on string categories, encoded out of fold inside each fold's train part: fold metrics and trees."""
    scores, trees = ME.fit_members(_member_matrix(spark, sf_dir).where("role <> 'test'"), [ME.MemberGroup("encoded", _SMALL, (7,))], range(K))
    m = EV.binary_metrics(scores, "p", "y", 0.5, by=["fold"]).join(EV.auc(scores, "p", "y", by=["fold"]), "fold")
    t = spark.createDataFrame([(f, n) for _, _, f, n in trees], "fold int, trees int")
    return rounded(m.join(t, "fold").select("fold", "n", "accuracy", "auc", "logloss", "trees"))


# the reference's parameters: a baseline of 400 trees, and up to 3000 that early stopping ends
_BASELINE = {"maxIter": 400, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.8", "validationTol": 0.001}
_STRONG = {"maxIter": 3000, "maxDepth": 6, "stepSize": 0.03, "subsamplingRate": 0.85, "featureSubsetStrategy": "0.7", "minInstancesPerNode": 3, "validationTol": 0.001}
LADDER = [
    ME.StageSpec("A0", "row", early=False, numeric=tuple(NUMERIC), params=(_BASELINE,)),
    ME.StageSpec("A1", "group", numeric=tuple(NUMERIC), params=(_BASELINE,)),
    ME.StageSpec("A2", "group", numeric=tuple(NUMERIC), nominal=("home", "vip", "flag"), params=(_STRONG,)),
    ME.StageSpec("A3", "group", numeric=tuple(NUMERIC), nominal=("home", "vip", "flag"), encoder="plain", encoded=("dest", "deck"), refit=True, params=(_STRONG,)),
    ME.StageSpec("A3b", "group", numeric=tuple(NUMERIC), nominal=("home", "vip", "flag"), encoder="oof", encoded=("dest", "deck"), refit=True, aggregates=True, params=(_STRONG,)),
    ME.StageSpec("A4", "group", numeric=tuple(NUMERIC), nominal=("home", "vip", "flag"), encoder="oof", encoded=("dest", "deck"), refit=True, params=(_STRONG, {**_STRONG, "maxDepth": 4})),
    ME.StageSpec("A5", "group", numeric=tuple(NUMERIC), nominal=("home", "vip", "flag"), encoder="oof", encoded=("dest", "deck"), refit=True, params=(_STRONG,), threshold="best"),
    ME.StageSpec("A6", "group", numeric=tuple(NUMERIC), nominal=("home", "vip", "flag"), encoder="oof", encoded=("dest", "deck"), refit=True, params=(_STRONG,), seeds=(42, 2024, 7, 1337, 88)),
    ME.StageSpec("A7", "group", numeric=tuple(NUMERIC), encoder="loo", encoded=("dest",), params=(_STRONG,), blend_with="A6"),
]


@register("l_stage_ladder", "L20/P10")
def l_stage_ladder(spark, sf_dir):
    """Stages A0 to A7 (folds, early stopping, nominal slots, encoder, search, threshold, seeds, blend) and their differences to A0 and A1."""
    return rounded(ME.ladder(_folded(spark, sf_dir), LADDER, K, _ROLES, "A0", "A1").drop("place"))


@register("l_pseudo_rounds", "L16")
def l_pseudo_rounds(spark, sf_dir):
    """Scores, confident test rows with their predicted label, refit on train and these, score: counts of each round."""
    train, test = _frame(spark, sf_dir)
    test = test.withColumn("y", F.lit(None).cast("double"))

    def fit_score(fit, rows):
        model = Pipeline(stages=[*_stages(), MO.logistic("y", 1.0, fit.count())]).fit(fit)
        return MO.probability(model.transform(rows))

    scores, log = ME.pseudo_label_rounds(train, test, fit_score, hi=0.36, lo=0.31, rounds=2)
    t = spark.createDataFrame([tuple(r.values()) for r in log], "round int, n_train long, n_confident long, n_positive long, refitted boolean")
    return rounded(attach_row(t, scores.agg(F.count(F.lit(1)).alias("scored"), F.avg("p").alias("mean_p"))))


def _forest_draw(rng: random.Random) -> dict:
    """A forest of the search space; depth and trees are below the reference's (800 to 3400 trees without a depth), as a driver holds a forest's nodes."""
    return {"numTrees": rng.choice([100, 200, 300]), "maxDepth": rng.choice([8, 10, 12]), "minInstancesPerNode": rng.choice([1, 2, 3, 4, 5])}


def _boosted_draw(rng: random.Random) -> dict:
    """Boosted trees of the reference's search space; early stopping ends them before ``maxIter``."""
    return {"maxIter": rng.randint(300, 3000), "maxDepth": rng.choice([4, 5, 6, 7, 8, 9, 10]), "stepSize": round(math.exp(rng.uniform(math.log(0.01), math.log(0.15))), 4)}


@register("l_tree_search", "L17")
def l_tree_search(spark, sf_dir):
    """Seeded random configurations of forests and boosted trees (early stopping on a slice of the train part), ranked by mean fold
    accuracy, the earlier one on ties."""
    train, _ = _frame(spark, sf_dir)
    _, x = MO.prepared(_stages(), train.withColumn("is_val", C.hash_bucket(10, "id", seed=5) == 0), ("id", "y", "fold", "is_val"))
    rng = random.Random(17)
    draws = [("forest", _forest_draw(rng)) for _ in range(2)] + [("boosted", _boosted_draw(rng)) for _ in range(2)]
    rows = []
    for i, (kind, params) in enumerate(draws):
        own = {} if kind == "forest" else {"validationIndicatorCol": "is_val", "validationTol": 0.001}
        make = RandomForestClassifier if kind == "forest" else GBTClassifier
        oof, _, _ = MO.run_cv(x, lambda f: make(featuresCol="features", labelCol="y", seed=f, **own, **params), [], "fold", K, keep=("id", "y"))
        per = EV.binary_metrics(oof, "p", "y", 0.5, by=["fold"]).agg(F.avg("accuracy").alias("a"), F.stddev_pop("accuracy").alias("s")).first()
        rows.append((i, kind, ", ".join(f"{k}={v}" for k, v in params.items()), per["a"], per["s"]))
    t = spark.createDataFrame(rows, "draw int, kind string, params string, accuracy double, spread double")
    return rounded(t.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("accuracy"), "draw"))))  # a row per draw


@register("l_forest_check", "L2")
def l_forest_check(spark, sf_dir):
    """L2: two forests on 80 % of each label, checked on the other 20 % (member mean), then refitted on all for the test rows."""
    train, test = _frame(spark, sf_dir)
    parts = materialize(FO.stratified_holdout(train, "id", "y", 0.2, seed=2), "holdout", FILE_ROWS)

    def mean_of(fit, rows):
        prep, x = MO.prepared(_stages(), fit, ("y",))
        models = [(seed, MO.fit(RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=10, maxDepth=5, seed=seed), x)) for seed in (1, 2)]
        scores = MO.member_scores(prep.transform(rows), models, ("id", "y"))
        return scores.groupBy("id", "y").agg(F.avg("p").alias("p"), F.count(F.lit(1)).alias("members"))

    valid = parts.where("holdout = 'valid'")
    checked = EV.binary_metrics(mean_of(parts.where("holdout = 'train'"), valid), "p", "y", 0.5).select("n", F.col("accuracy").alias("check_accuracy"))
    scored = mean_of(train, test).agg(F.count(F.lit(1)).alias("test_rows"), F.avg("p").alias("test_mean"), F.min("members").alias("members"))
    return rounded(attach_row(checked, scored))


@register("l_seed_bagging", "L12")
def l_seed_bagging(spark, sf_dir):
    """Same folds, two model seeds (forests), out-of-fold mean per id."""
    train, _ = _frame(spark, sf_dir)
    parts = None
    for seed in (11, 12):
        oof, _, _ = MO.run_cv(
            train, lambda f, s=seed: RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=10,
                                                            maxDepth=4, seed=s * 10 + f),
            _stages(), "fold", K, seed=seed, keep=("id", "y"))
        parts = oof if parts is None else parts.unionByName(oof)
    bagged = parts.groupBy("id", "y").agg(F.avg("p").alias("p"), F.count(F.lit(1)).alias("members"))
    return rounded(EV.binary_metrics(bagged, "p", "y", 0.5).select("accuracy", "logloss", "n"))


@register("l_random_search", "L17/L18/L19")
def l_random_search(spark, sf_dir):
    """Seeded random draws from a search space + a named candidate list, cross-validated
    on the fixed fold column; table sorted by score."""
    train, _ = _frame(spark, sf_dir)
    lr = LogisticRegression(featuresCol="features", labelCol="y", maxIter=50, standardization=False)
    rng = random.Random(42)
    space = [{"regParam": 10 ** rng.uniform(-4, 0), "elasticNetParam": rng.choice([0.0, 0.5, 1.0])} for _ in range(3)]
    named = [{"regParam": 1e-3, "elasticNetParam": 0.0}, {"regParam": 1e-1, "elasticNetParam": 0.0}]
    grid = [{lr.regParam: c["regParam"], lr.elasticNetParam: c["elasticNetParam"]} for c in space + named]
    means, _ = MO.grid_cv(train, _stages(), lr, grid, BinaryClassificationEvaluator(labelCol="y"), "fold", K)
    rows = [(("random" if i < len(space) else "named"), float(c["regParam"]), float(c["elasticNetParam"]), float(m))
            for i, (c, m) in enumerate(zip(space + named, means))]
    t = spark.createDataFrame(rows, "kind string, reg_param double, elastic_net double, auc double")
    return rounded(t.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("auc"), "reg_param"))))  # one row per config


STAGES = {
    "A0": (["age"], []),
    "A1": (["age", "a1", "a2"], []),
    "A2": (NUMERIC, []),
    "A3": (NUMERIC, CATEGORICAL),
}


@register("l_ablation", "L20")
def l_ablation(spark, sf_dir):
    """Stage ladder of feature sets, k-fold accuracy and AUC per stage, delta to the first stage."""
    train, _ = _frame(spark, sf_dir)
    n = train.count()
    rows = []
    for name, (num, cat) in STAGES.items():
        oof, _, _ = MO.run_cv(train, lambda f: MO.logistic("y", 1.0, n * (K - 1) / K), _stages(num, cat), "fold", K, keep=("id", "y"))
        oof = materialize(oof, "oof")
        m = attach_row(EV.binary_metrics(oof, "p", "y"), EV.auc(oof, "p", "y")).first()
        rows.append((name, float(m["accuracy"]), float(m["auc"] or 0.0)))
    t = spark.createDataFrame(rows, "stage string, accuracy double, auc double")
    base = rows[0][1]
    return rounded(t.withColumn("delta", F.col("accuracy") - F.lit(base)))


@register("l_importance_topk", "L22/M14")
def l_importance_topk(spark, sf_dir):
    """Forest and boosted-tree importances joined to slot names, the mean over two seeds divided
    by each model's maximum."""
    train, _ = _frame(spark, sf_dir)
    prep, x = MO.prepared(_stages(), train, ("y",))
    names = MO.slot_names(prep.transform(train))
    rows = []
    for seed in (1, 2):
        for family, est in (("rf", RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=20, maxDepth=5, seed=seed)),
                            ("gbt", GBTClassifier(featuresCol="features", labelCol="y", maxIter=10, maxDepth=3, subsamplingRate=0.8, seed=seed))):
            imp = MO.fit(est, x).featureImportances.toArray().tolist()
            rows += [(family, n, float(v), i) for i, (n, v) in enumerate(zip(names, imp))]
    return rounded(MO.importance_table(spark.createDataFrame(rows, "model string, feature string, importance double, original_order int")))


@register("l_topk_retrain", "L21")
def l_topk_retrain(spark, sf_dir):
    """Folds on all slots give mean importances; the best five slots are kept and the folds run again on them."""
    from pyspark.ml.feature import VectorSlicer

    train, _ = _frame(spark, sf_dir)

    def forest(features):
        return lambda f: RandomForestClassifier(featuresCol=features, labelCol="y", numTrees=20, maxDepth=5, seed=f)

    oof, _, models = MO.run_cv(train, forest("features"), _stages(), "fold", K, keep=("id", "y"))
    rows = []
    for m in models:
        names = MO.slot_names(m.transform(train.limit(1)))
        rows += [("rf", n, float(v), i) for i, (n, v) in enumerate(zip(names, m.stages[-1].featureImportances.toArray().tolist()))]
    t = MO.importance_table(spark.createDataFrame(rows, "model string, feature string, importance double, original_order int"))
    best = [r["feature"] for r in t.orderBy("rank").limit(5).collect()]
    top, _, _ = MO.run_cv(train, forest("top"), [*_stages(), VectorSlicer(inputCol="features", outputCol="top", names=best)], "fold", K, keep=("id", "y"))
    out = None
    for name, scores, n in (("all", oof, len(names)), ("top", top, len(best))):
        scores = materialize(scores, "oof")
        m = attach_row(EV.binary_metrics(scores, "p", "y"), EV.auc(scores, "p", "y"))
        m = m.select(F.lit(name).alias("features"), F.lit(n).alias("n_slots"), F.lit(", ".join(best)).alias("kept"), "accuracy", "auc", "n")
        out = m if out is None else out.unionByName(m)
    return rounded(out)


@register(
    "l_member_mean", "L12/L13/L22/M14",
    sql="""
    WITH i AS (SELECT family AS model, split AS feature, avg(p) AS importance, count(*) AS members, CAST(min(length(split)) AS INTEGER) AS original_order FROM p GROUP BY ALL)
    SELECT model, feature, round(importance, 6) AS importance, original_order, CAST(members AS BIGINT) AS members,
           round(importance / max(importance) OVER (PARTITION BY model), 6) AS normalised,
           CAST(row_number() OVER (PARTITION BY model ORDER BY importance DESC, original_order) AS INTEGER) AS rank FROM i""",
    fixtures=("p",),
)
def l_member_mean(spark, sf_dir):
    """Mean over members, division by the model's maximum and rank, on the score table
    (families stand for models, splits for features, rows for members)."""
    p = predictions(spark, sf_dir)
    return rounded(MO.importance_table(p.select(F.col("family").alias("model"), F.col("split").alias("feature"), F.col("p").alias("importance"), F.length("split").alias("original_order"))))


@register("l_oof_table", "A9/L10")
def l_oof_table(spark, sf_dir):
    """Out-of-fold scores of a logistic model written as (id, y_true, proba, pred, fold) and read back."""
    from tessera.sources.sinks import write_frame
    import uuid

    train, _ = _frame(spark, sf_dir)
    n = train.count()
    oof, _, _ = MO.run_cv(train, lambda f: MO.logistic("y", 1.0, n * (K - 1) / K), _stages(), "fold", K, keep=("id", "y"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-oof-{uuid.uuid4().hex}"
    MATERIALIZED.append(path)
    write_frame(oof.select("id", F.col("y").cast("int").alias("y_true"), F.col("p").alias("proba"), (F.col("p") >= 0.5).alias("pred"), "fold"), path)
    return rounded(spark.read.parquet(path))


@register("l_batch_scoring", "L23")
def l_batch_scoring(spark, sf_dir):
    """Fitted pipeline saved under the checkpoint folder, loaded back and applied to the test rows."""
    import uuid

    train, test = _frame(spark, sf_dir)
    model = Pipeline(stages=[*_stages(), MO.logistic("y", 1.0, train.count())]).fit(train)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-model-{uuid.uuid4().hex}"
    MATERIALIZED.append(path)
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    scored = MO.probability(loaded.transform(test))
    return rounded(scored.select("id", "p", (F.col("p") >= 0.5).alias("label")))


@register("k_leak_guard", "K8")
def k_leak_guard(spark, sf_dir):
    """K8: the assembled model input carries no audit, id or label column (raises otherwise)."""
    from tessera.operators.folds import assert_no_leak

    train, _ = _frame(spark, sf_dir)
    model = Pipeline(stages=_stages()).fit(train)
    names = MO.slot_names(model.transform(train.limit(1)))
    forbidden = ["id", "y", "split", "fold", "flag_rule", "age_out_of_range"]
    assert_no_leak([n.split("__")[0] for n in names], forbidden)
    rows = [(n, n.split("__")[0] in forbidden) for n in names]
    return spark.createDataFrame(rows, "slot string, forbidden boolean")


@register("l_honest_group_oof", "L14")
def l_honest_group_oof(spark, sf_dir):
    """Group folds (a group never on both sides) with the target encoder refitted inside each fold."""
    from tessera.operators import encode as EN
    from tessera.operators import folds as FO

    w = wide(spark, sf_dir).filter(F.col("split") == "train").select("id", "y", "dest", *NUMERIC, *CATEGORICAL)
    w = w.withColumn("group_id", C.split_id("id")[0]).fillna("Unknown", subset=CATEGORICAL)
    w = FO.stratified_group_kfold(w, "group_id", "y", K).withColumn("y", F.col("y").cast("double"))
    w = materialize(w, "group-folds")
    oof = None
    for f in range(K):
        # encoder fitted on the fold's train part only; written, as the feature stages, the fit and the scores read it
        fitted = materialize(EN.target_encode(w, "dest", "y", F.col("fold") != f).drop("dest"), "encoded", FILE_ROWS)
        train = fitted.filter(F.col("fold") != f)
        model = MO.fit(Pipeline(stages=[*_stages(NUMERIC + ["te_dest"], CATEGORICAL), MO.logistic("y", 1.0, train.count())]), train)
        part = MO.probability(model.transform(fitted.filter(F.col("fold") == f))).select("id", "y", F.lit(f).alias("fold"), "p")
        oof = part if oof is None else oof.unionByName(part)
    oof = materialize(oof, "oof")  # scored once for both tables
    m = EV.binary_metrics(oof, "p", "y", 0.5, by=["fold"]).join(EV.auc(oof, "p", "y", by=["fold"]), "fold")
    return rounded(m.select("fold", "accuracy", "auc", "n"))
