"""Power fits, level quantiles, fold statistics, members, pseudo labels and the stored common frame on hand-made rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import encode as EN
from tessera.operators import evaluate as EV
from tessera.operators import features as FE
from tessera.operators import folds as FO
from tessera.operators import members as ME
from tessera.operators import profile as PR
from tessera.operators import transforms as TR
from tessera.operators.profile import level_quantiles
from tessera.sources import readers as RD
from tessera.sources import sinks as SK

K = 3


def likelihood(x, lam, method):
    """Brute force, with the transform as it is written in textbooks."""
    if method == "box-cox":
        y = np.log(x) if lam == 0 else x**lam / lam
        jacobian = np.log(x).sum()
    else:
        pos, neg = x[x >= 0], x[x < 0]
        y = np.concatenate([np.log1p(pos) if lam == 0 else (pos + 1) ** lam / lam, (-np.log1p(-neg) if lam == 2 else -((1 - neg) ** (2 - lam) - 1) / (2 - lam)) + (0 if lam == 0 else 1 / lam)])
        jacobian = (np.sign(x) * np.log1p(np.abs(x))).sum()
    return -len(x) / 2 * np.log(y.var()) + (lam - 1) * jacobian


@pytest.mark.parametrize("name", ["skewed", "signed", "inverse", "steep"])
def test_power_fit_reaches_the_optimum(spark, name):
    rng = np.random.default_rng(5)
    x, method = {
        "skewed": (rng.lognormal(1, 0.7, 400), "yeo-johnson"),
        "signed": (rng.normal(0, 1, 400) ** 3, "yeo-johnson"),
        "inverse": (1 / (rng.normal(6, 0.5, 400)) ** 0.2, "box-cox"),
        "steep": (rng.normal(40, 3, 400) ** 0.125, "box-cox"),
    }[name]
    df = spark.createDataFrame([(float(v), 1) for v in x] + [(None, 1), (1e9, 0)], "x double, fit int")
    fit = TR.fit_power(df, {"x": method}, F.col("fit") == 1)["x"]
    grid = np.arange(-30, 30, 0.01)
    rough = grid[int(np.argmax([likelihood(x, g, method) for g in grid]))]
    fine = np.arange(rough - 0.02, rough + 0.02, 2e-5)
    best = fine[int(np.argmax([likelihood(x, g, method) for g in fine]))]
    assert abs(fit.lam - best) < 1e-4
    assert name != "steep" or abs(fit.lam) > 2
    z = np.array([r.z for r in df.where("fit = 1 and x is not null").select(TR.power_column("x", fit).alias("z")).collect()])
    assert abs(z.mean()) < 1e-6 and abs(z.std() - 1) < 1e-6
    assert df.where("x is null").select(TR.power_column("x", fit).alias("z")).first().z is None


def test_power_fits_that_fail(spark):
    df = spark.createDataFrame([(2.0, -1.0, None)] * 5, "same double, negative double, empty double")
    fits = TR.fit_power(df, {"same": "yeo-johnson", "negative": "box-cox", "empty": "yeo-johnson"}, F.lit(True))
    assert all(f.lam is None for f in fits.values())
    assert df.select(TR.power_column("same", fits["same"]).alias("z")).first().z == 0.0


def test_component_is_the_first_singular_vector(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, float(v) if i % 9 else None, "train" if i % 4 else "test") for i, v in enumerate(rng.lognormal(0, 1, 300))], "id long, v double, split string")
    out, names = FE.all_power_features(df, "v", F.col("split") == "train")
    rows = out.orderBy("id").collect()
    train = np.array([[r[n] for n in names[:-1]] for r in rows if r.split == "train"])
    vector = np.linalg.svd(train, full_matrices=False)[2][0]
    got = np.array([r.v_pca_comb for r in rows if r.split == "train"])
    assert len(names) == 9 and min(np.abs(train @ vector - got).max(), np.abs(train @ vector + got).max()) < 1e-8


def test_level_quantiles_in_one_pass(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([None, 0.0, rng.random() * 10])) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, h int, x double")
    out = level_quantiles(df, [(["g", "h"], ["x"]), (["h"], ["x", ("neg", -F.col("x"))]), ([], ["x"])], [0.5, 0.2]).collect()
    for r in out:
        sign = -1 if r.variable == "neg" else 1
        own = sorted(sign * x for g, h, x in rows if x is not None and (r.level > 0 or g == r.g) and (r.level > 1 or h == r.h))
        assert r.n == len(own) and abs(r.q0 - np.quantile(own, 0.5)) < 1e-12 and abs(r.q1 - np.quantile(own, 0.2)) < 1e-12
    assert len(out) == 6 + 4 + 1


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows = []
    for i in range(240):
        city = rng.choice(["x", "y", "z", None]) if i % 40 else "rare"
        fold = None if i % 6 == 0 else i % K
        rows.append((f"i{i}", f"g{i // 2}", city, f"s{i % 7}" if i % 5 else None, float(i % 50), rng.choice([None, 30.0, 40.0]), rng.random(), rng.choice(["True", "False", None]), None if fold is None else float(rng.random() < 0.4), fold, i % 5))
    return rows, spark.createDataFrame(rows, "id string, grp string, city string, surname string, num double, age double, total double, flag string, y double, fold int, inner int").cache()


ROLES = {"surname": "surname", "group": "grp", "number": "num", "age": "age", "total": "total", "flag": "flag"}


@pytest.mark.parametrize("mode", ["plain", "loo", "oof"])
def test_fold_encoders_by_definition(labelled, mode):
    rows, df = labelled
    out = FO.fold_feature_pack(df, "y", "fold", K, ["city"], mode, **ROLES)
    m, of = 20.0, {r[0]: r for r in rows}
    mean = lambda rs: sum(r[8] for r in rs) / len(rs)

    def rate(rs, level, default):
        own = [r for r in rs if r[2] == level]
        return (sum(r[8] for r in own) + mean(rs) * m) / (len(own) + m) if own else default

    got = out.collect()
    assert len(got) == len(rows) * K
    for r in got:
        fit = [x for x in rows if x[9] is not None and x[9] != r.fit_fold]
        x = of[r.id]
        assert r.role == ("test" if x[9] is None else "valid" if x[9] == r.fit_fold else "train")
        want = rate(fit, x[2], mean(fit))
        if r.role == "train" and mode == "loo":
            own = [z for z in fit if z[2] == x[2]]
            want = (sum(z[8] for z in own) - x[8] + mean(fit) * m) / (len(own) - 1 + m)
        if r.role == "train" and mode == "oof":
            want = rate([z for z in fit if z[10] != x[10]], x[2], mean(fit))
        assert abs(r.te_city - want) < 1e-12
        assert r.surname_freq == sum(1 for z in fit if z[3] is not None and z[3] == x[3])


@pytest.mark.parametrize("mode", ["plain", "oof"])
def test_no_label_of_the_fold_reaches_its_features(spark, labelled, mode):
    rows, df = labelled
    other = df.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    keys = ["id", "role", "te_city", "surname_rate", "surname_freq", "num_bin"]
    a, b = (sorted(map(str, FO.fold_feature_pack(x, "y", "fold", K, ["city"], mode, **ROLES).where("fit_fold = 1").select(*keys).collect())) for x in (df, other))
    assert a == b  # flipping the labels of fold 1 changes nothing that fold 1's model sees
    if mode == "oof":  # and a row's own label never reaches its own value
        flipped = df.withColumn("y", F.when(F.col("id") == "i1", 1 - F.col("y")).otherwise(F.col("y")))
        own = [FO.fold_encode(FO.fold_frame(x, "fold", K), x, "city", "y", "fold", K, "oof", "te", 20.0).where("id = 'i1' and role = 'train'").select("te", "fit_fold").collect() for x in (df, flipped)]
        # only the fallback to the train part's rate may hold it, and the level is not rare
        assert sorted(map(str, own[0])) == sorted(map(str, own[1]))


def test_members_score_every_row_once(spark, labelled):
    rows, df = labelled
    spec = ME.StageSpec("s", "row", numeric=("num", "total"), nominal=("flag",), encoder="oof", encoded=("city",), refit=True)
    matrix = ME.stage_matrix(df.withColumn("fold_row", F.col("fold")), spec, K, ROLES)
    groups = [ME.MemberGroup("a", {"maxIter": 2, "maxDepth": 2}, (1, 2)), ME.MemberGroup("b", {"maxIter": 2, "maxDepth": 3}, (1,))]
    scores, trees = ME.fit_members(matrix, groups, range(K))
    assert len(trees) == 3 * K and all(t[3] >= 1 for t in trees)
    valid = scores.where("role = 'valid'").groupBy("group", "seed", "id").count()
    assert valid.where("count <> 1").count() == 0 and valid.count() == 3 * sum(r[9] is not None for r in rows)
    assert scores.where("role = 'test'").count() == 3 * K * sum(r[9] is None for r in rows)
    again, _ = ME.fit_members(matrix, groups[:1], range(K))
    key = ["id", "group", "seed", "fold"]
    assert scores.join(again.withColumnRenamed("p", "q"), [*key, "role"]).where("abs(p - q) > 1e-12").count() == 0
    means = ME.group_scores(scores)
    chosen = ME.select_groups(means, ["a", "b"])
    acc = {n: EV.binary_metrics(means.where(f"group = '{n}' and role = 'valid'"), "p", "y", 0.5).first()["accuracy"] for n in "ab"}
    assert chosen[0] == max("ab", key=lambda n: (acc[n], n == "a"))
    assert ME.final_tree_count(trees, 100) == 100 and ME.final_tree_count([("a", 1, 0, 3), ("a", 1, 1, 6)], 1) == 4
    with pytest.raises(ValueError, match="too many levels"):
        ME.assemble(df, ["num"], ["id"])


def test_pseudo_label_rounds(spark):
    train = spark.createDataFrame([(f"t{i}", float(i), float(i >= 50)) for i in range(100)], "id string, x double, y double")
    test = spark.createDataFrame([(f"u{i}", float(i)) for i in range(-50, 150)], "id string, x double").withColumn("y", F.lit(None).cast("double"))
    seen = []

    def fit_score(fit, rows):
        seen.append({r.id: r.y for r in fit.collect()})
        return rows.select("id", (1 / (1 + F.exp(-(F.col("x") - 49.5) / 10))).alias("p"))

    scores, log = ME.pseudo_label_rounds(train, test, fit_score, hi=0.98, lo=0.02, least=100, rounds=2)
    sure = {f"u{i}": float(i > 50) for i in range(-50, 150) if not 0.02 < 1 / (1 + math.exp(-(i - 49.5) / 10)) < 0.98}
    assert [r["refitted"] for r in log] == [True, True, True] and log[1]["n_confident"] == len(sure) and log[1]["n_train"] == 100 + len(sure)
    assert len(seen) == 3 and {k: v for k, v in seen[1].items() if k in sure} == sure and len(seen[2]) == 100 + len(sure) and scores.count() == 200
    _, log = ME.pseudo_label_rounds(train, test, fit_score, hi=0.99999, lo=0.00001, least=100, rounds=3)
    assert len(log) == 2 and not log[1]["refitted"] and log[1]["n_train"] == 100


def test_common_unit_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.0, 0), ("b", None, 3.0, 1)], "id string, y int, x double, fold int")
    SK.store_common(df, str(tmp_path / "c"), ["x"], ["fold"], EN.level_index(df, ["id"]))
    back = RD.load_common(spark, str(tmp_path / "c"), SK.COMMON_VERSION, label="y")
    assert back.rows.columns == df.columns and sorted(map(str, back.rows.collect())) == sorted(map(str, df.collect()))
    assert (back.features, back.folds, back.levels.count()) == (["x"], ["fold"], 2)
    with pytest.raises(ValueError, match="version"):
        RD.load_common(spark, str(tmp_path / "c"), SK.COMMON_VERSION + 1)
    with pytest.raises(ValueError, match="lacks"):
        SK.store_common(df, str(tmp_path / "d"), ["nope"])
    SK.store_common(df, str(tmp_path / "e"), ["y"])
    with pytest.raises(ValueError, match="features"):
        RD.load_common(spark, str(tmp_path / "e"), SK.COMMON_VERSION, label="y")
    SK.store_common(df.unionByName(df), str(tmp_path / "f"), ["x"])
    with pytest.raises(ValueError, match="repeated"):
        RD.load_common(spark, str(tmp_path / "f"), SK.COMMON_VERSION)


def test_one_hot_without_driver_levels(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), (None, 1), ("c", 0)], "c string, fit int")
    out = {r.c: r.c_ohe for r in EN.one_hot(df, "c", F.col("fit") == 1).collect()}
    assert out == {"a": [1.0, 0.0], "b": [0.0, 1.0], None: [0.0, 0.0], "c": [0.0, 0.0]}


def test_feature_options():
    assert FE.resolve_options({"include_surname": 1, "unknown": True})["include_surname"] is True and "unknown" not in FE.resolve_options({"unknown": True})
    names = FE.optional_columns(FE.resolve_options(None))
    assert len(names) == len(set(names)) and "surname" not in names and "surname_freq" in names
    spec = FE.feature_spec("knn", ["id", *FE.EVERY_FEATURE])
    assert spec["categorical"] == [] and "id" in spec["dropped"]
    with pytest.raises(ValueError):
        FE.feature_spec("cat", ["age"])


def test_level_quantiles_add_up_counts_of_the_finest_keys(spark, monkeypatch):
    rows = [(("x", "y", None)[i % 3], ("p", "q")[i // 3 % 2], float(i * i % 41) if i % 7 else None, -float(i % 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, u double, v double")
    plus = ("pos_u", F.when(F.col("u") > 3, F.col("u")))
    plans, write = [], PR.materialize
    monkeypatch.setattr(PR, "materialize", lambda t, name: (plans.append(t._jdf.queryExecution().optimizedPlan().toString()), write(t, name))[1])
    found = PR.level_quantiles(df, [(["a", "b"], ["u", "v"]), (["b"], ["u"]), ([], ["u", "v", plus])], [0.25, 0.5]).collect()
    assert "Generate" not in plans[0][plans[0].index("Union"):]  # rows are not copied to levels, their counts are
    got = {(r.level, r.a, r.b, r.variable): (r.n, r.q0, r.q1) for r in found}
    want = {}
    for level, by, values in ((0, ["a", "b"], ["u", "v"]), (1, ["b"], ["u"]), (2, [], ["u", "v", plus])):
        for r in PR.exact_quantiles(df, values, [0.25, 0.5], by=by).collect():
            want[level, r.asDict().get("a"), r.asDict().get("b"), r.variable] = (r.n, r.q0, r.q1)
    assert got == want and len(got) == 6 * 2 + 2 + 3


def test_folds_and_members_multiply_no_written_rows(spark, labelled, monkeypatch):
    """Copies for folds are written once and narrow, scores once for all members of a fold."""
    rows, df = labelled
    written = {}
    for module in (FO, ME):
        def record(t, name="frame", write=module.materialize):
            written[name] = out = write(t, name)
            return out

        monkeypatch.setattr(module, "materialize", record)
    spec = ME.StageSpec("s", "row", numeric=("total",), encoder="plain", encoded=("city",), refit=True)
    matrix = ME.stage_matrix(df.withColumn("fold_row", F.col("fold")).withColumn("unused", F.lit("x")), spec, K, ROLES)
    copied = [n for n, t in written.items() if "fit_fold" in t.columns and "id" in t.columns]
    assert copied == ["stage"] and "unused" not in written["pack-rows"].columns
    assert sorted(written["stage"].columns) == sorted(["id", "y", "fit_fold", "role", "total", "te_city", "surname_freq", "num_bin"])
    scores, _ = ME.fit_members(matrix, [ME.MemberGroup("a", {"maxIter": 1, "maxDepth": 1}, (1, 2))], range(K))
    asked = matrix.where("role <> 'train'").count()
    assert written["members"].count() == asked and scores.count() == 2 * asked


def test_power_moments_merge_over_tasks(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 3, 500), [0.0, -1.0]])
    rows = [(float(v), float(abs(v)) + 1e6) for v in x] + [(None, None)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    asked = {"a": ("yeo-johnson", [0.0, 0.5, 2.0, -3.0]), "b": ("box-cox", [0.0, 1.5])}
    found = TR._likelihood_moments(df, asked)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    own = {(k, i): likelihood(v, lam, method) for k, (v, (method, lams)) in enumerate(zip((x, np.abs(x) + 1e6), asked.values())) for i, lam in enumerate(lams)}
    got = TR._likelihoods(df, asked)
    for k, c in enumerate(asked):
        assert [lam for lam, _ in got[c]] == asked[c][1]
        assert all(abs(value - own[k, i]) < 1e-8 * abs(own[k, i]) + 1e-6 for i, (_, value) in enumerate(got[c]))
    assert {(r.k, r.i): r.n for r in found.collect()} == {key: len(x) for key in own}
