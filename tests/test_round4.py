"""Round 4: whole jobs of the model queries, and steps that were changed to scale."""

import random
import subprocess

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tessera.operators import blend as BL
from tessera.operators import core
from tessera.operators import members as ME
from tessera.operators import models as MO
from tessera.operators import neighbours as NE
from tessera.operators import profile as PR
from tessera.plans import catalog_models as CM
from tessera.plans import common_frame as CF
from tessera.plans.registry import load_all
from tessera.sources.fixtures import wide

SMOKE = "/root/testdata/sf0.001"
QUERIES = load_all()


def test_seed_ensemble_fits_a_hundred_trees_at_least(spark, monkeypatch):
    """the final members have the mean of the folds' trees, 100 at least; no cap ends the folds before their early stopping."""
    seen = {}
    matrix = spark.createDataFrame([("a", "test", 0.5)], "id string, role string, p double")
    monkeypatch.setattr(CM, "_member_matrix", lambda *_: matrix)
    monkeypatch.setattr(ME, "fit_members", lambda m, groups, folds: seen.update(caps=[g.params["maxIter"] for g in groups]) or (None, [("cv", 1, f, 7) for f in folds]))
    monkeypatch.setattr(ME, "final_members", lambda m, params, trees, seeds: seen.update(trees=trees, seeds=seeds) or m.select("id", "p"))
    assert CM.l_seed_ensemble(spark, SMOKE).first()["trees"] == 100
    assert seen["trees"] == 100 and len(seen["seeds"]) == 3 and min(seen["caps"]) >= 100


def test_ladder_fits_the_reference_trees():
    """400 trees without early stopping, else up to a cap that the stop and not the parameter decides; five seeds; depth 6."""
    by = {s.name: s for s in CM.LADDER}
    assert not by["A0"].early and all(s.early for n, s in by.items() if n != "A0")
    assert all(p["maxIter"] >= 400 for s in CM.LADDER for p in s.params)
    assert all(max(p["maxDepth"] for p in s.params) == 6 for s in CM.LADDER)
    assert len(by["A6"].seeds) == 5 and len(by["A4"].params) > 1


def test_tree_search_draws_models_of_some_size():
    """forests of 100 trees at least, boosted trees that early stopping ends."""
    rng = random.Random(1)
    forests, boosted = [CM._forest_draw(rng) for _ in range(50)], [CM._boosted_draw(rng) for _ in range(50)]
    assert min(d["numTrees"] for d in forests) >= 100 and min(d["maxDepth"] for d in forests) >= 8
    assert min(d["maxIter"] for d in boosted) >= 300 and {d["maxDepth"] for d in boosted} == set(range(4, 11))


def _shuffle_files(spark):
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getParent()
    return int(subprocess.run(f"find {folder} -name 'shuffle_*.data' | wc -l", shell=True, capture_output=True, text=True).stdout)


def test_written_tables_leave_no_shuffle_files_and_settings(spark):
    """F14 and others: a written table's shuffles go with the write."""
    before, keys = _shuffle_files(spark), ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.codegen.hugeMethodLimit")
    settings = [spark.conf.get(k, None) for k in keys]
    t = core.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")), "t")
    assert t.count() == 7 and [spark.conf.get(k, None) for k in keys] == settings
    assert _shuffle_files(spark) <= before + 1  # the count's own


def test_settled_keeps_its_own_table_only(spark):
    """F14 and others: tables on the way to a settled frame are removed, those before it stay."""
    first = core.materialize(spark.range(5), "first")
    n = len(core.MATERIALIZED)
    out = core.settled(lambda: core.materialize(first.union(first), "step").groupBy("id").count(), "out")
    assert len(core.MATERIALIZED) == n + 1 and {r["count"] for r in out.collect()} == {2} and first.count() == 5
    step = [p for p in core.MATERIALIZED if "tessera-step-" in p]
    assert not step


def test_common_frame_holds_no_steps(spark):
    """F14 and others: the common frame leaves its frame, quantiles and surnames, not the tables they were made from."""
    n = len(core.MATERIALIZED)
    assert CF.build(wide(spark, SMOKE)).count() == 6000
    assert [p.rsplit("/", 1)[1].split("-")[1] for p in core.MATERIALIZED[n:]] == ["frame", "quantiles", "surnames"]


def test_positive_quantiles_come_from_the_same_counts(spark):
    """F14 and others: a rule on a level's values gives what a column of those values gives."""
    rows = [(i % 3, float(i - 5) if i % 4 else None) for i in range(40)] + [(7, -1.0)]
    df = spark.createDataFrame(rows, "k int, x double")
    one = PR.level_quantiles(df, [(["k"], ["x"]), ([], ["x", ("pos", F.col("x"), lambda v: v > 0)])], [0.5, 0.9])
    two = PR.level_quantiles(df, [(["k"], ["x"]), ([], ["x", ("pos", F.when(F.col("x") > 0, F.col("x")))])], [0.5, 0.9])
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_kind_views_send_plain_rows(spark):
    """the shuffle by document carries a family's number, score and rank, not partial structs of all families."""
    rows = [(f"i{i}", "train" if i % 3 else "test", i % 2, f, float((i * 7 + j) % 5)) for i in range(30) for j, f in enumerate(("a", "b"))]
    scores = spark.createDataFrame(rows, "id string, split string, y int, family string, p double")
    views = BL.kind_views(scores, ["a", "b"])
    plan = views._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "partial_max" in plan
    assert plan.index("partial_max") < plan.index("REPARTITION_BY_NUM")  # above it, so what is sent are rows
    for r in views.collect():
        for f in ("a", "b"):
            own = [x for x in rows if x[1] == r["split"] and x[3] == f]
            place = sorted((x[4], x[0]) for x in own).index((r["prob"][f], r["id"]))
            assert r["rank"][f] == place / (len(own) - 1)


def test_fusion_search_drops_the_ranks_it_was_made_from(spark):
    """the ordered scores go once the views are written."""
    n = len(core.MATERIALIZED)
    QUERIES["n_fusion_search"].fn(spark, SMOKE).count()
    left = [p.rsplit("/", 1)[1].split("-")[1] for p in core.MATERIALIZED[n:]]
    assert "views" in left and "ordered" not in left


def test_parts_are_what_copies_to_the_folds_give(spark):
    """a count for each part gives the quantiles of rows copied to the parts; a row without a fold is in all of them."""
    rows = [(i % 4 if i % 9 else None, f"g{i % 3}" if i % 5 else None, float(i * i % 17) if i % 7 else None) for i in range(80)]
    df = spark.createDataFrame(rows, "fold int, k string, x double")
    levels = [(["k"], ["x"]), ([], ["x", ("pos", F.col("x"), lambda v: v > 3)])]
    inside = [F.coalesce(F.col("fold") != f, F.lit(True)) for f in range(4)]
    one = PR.level_quantiles(df, levels, [0.5, 0.2], parts=inside, part="fit_fold")
    copied = df.withColumn("fit_fold", F.explode(F.filter(F.array(*[F.lit(f) for f in range(4)]), lambda f: F.coalesce(f != F.col("fold"), F.lit(True)))))
    two = PR.level_quantiles(copied, levels, [0.5, 0.2], by=["fit_fold"])
    cols = ["fit_fold", "level", "k", "variable", "n", "q0", "q1"]
    assert sorted(map(tuple, one.select(cols).collect()), key=str) == sorted(map(tuple, two.select(cols).collect()), key=str)


def test_fold_common_frame_writes_no_copies_of_rows(spark):
    """the rows of the folds' common frame are written once, not once a fold."""
    w = wide(spark, SMOKE).where("split = 'train'").withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(5)).cast("int"))
    n = len(core.MATERIALIZED)
    rows = w.count()
    assert CF.build_folds(w, "fold", 5).count() == rows
    written = [p for p in core.MATERIALIZED[n:] if "tessera-fold-rows-" in p]
    assert [spark.read.parquet(p).count() for p in written] == [rows]
    assert not [p for p in core.MATERIALIZED[n:] if "tessera-rows-" in p or "tessera-counts-" in p]


def test_search_works_on_few_queries_at_once(monkeypatch):
    """The search in a tile gives the same pairs whatever the number of queries at once; the smaller id stays on ties."""
    rng = np.random.default_rng(3)
    q, r = rng.integers(0, 4, (90, 3)).astype(float), rng.integers(0, 4, (70, 3)).astype(float)
    row = pa.struct([("id", pa.string()), ("x", pa.list_(pa.float64()))])
    asked = [{"id": f"q{i:03d}", "x": list(x), "reach": float("inf") if i % 2 else 2.0} for i, x in enumerate(q)]
    held = [{"id": f"r{i:03d}", "x": list(x)} for i, x in enumerate(r)]
    kinds = pa.schema([("q", pa.string()), ("q_mask", pa.int64()), ("mask", pa.int64()), ("asked", pa.list_(pa.struct([*row, ("reach", pa.float64())]))), ("rows", pa.list_(row))])
    tile = pa.RecordBatch.from_pylist([{"q": "b", "q_mask": 7, "mask": 7, "asked": asked, "rows": held}], schema=kinds)
    expected = set()
    for a, x in zip(asked, q):
        near = sorted((float(((x - y) ** 2).sum()), h["id"]) for h, y in zip(held, r))
        expected |= {(a["id"], other, d) for d, other in [n for n in near if n[0] <= a["reach"]][:4]}
    sizes = []
    for cached in (70, 1000, 10**6):
        monkeypatch.setattr(NE, "CACHED", cached)
        seen = NE._near
        monkeypatch.setattr(NE, "_near", lambda part, *rest: sizes.append(len(part)) or seen(part, *rest))
        found = pa.Table.from_batches(list(NE._search(iter([tile]), 3, 4))).to_pylist()
        monkeypatch.setattr(NE, "_near", seen)
        assert {(f["id"], f["other"], f["d2"]) for f in found} == expected and len(found) == len(expected)
    assert set(sizes) == {1, 14, 6, 90}


def test_honest_folds_read_written_encodings(spark):
    """each fold's encoded rows are written once for its stages, fit and scores; the levels of all categories are one pass."""
    n = len(core.MATERIALIZED)
    assert {r["fold"] for r in QUERIES["l_honest_group_oof"].fn(spark, SMOKE).collect()} == set(range(CM.K))
    assert len([p for p in core.MATERIALIZED[n:] if "tessera-encoded-" in p]) == CM.K
    assert sum(isinstance(s, StringIndexer) for s in MO.feature_pipeline(["a"], ["b", "c"])) == 1
