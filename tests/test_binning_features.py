import pytest
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import profile as PR
from tessera.operators.binning import apply_quantile_bins, fit_quantile_edges
from tessera.operators.core import attach_row
from tessera.plans.common_frame import age_group


def _bins(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    edges = fit_quantile_edges(df, "x", 5)
    return [r.b for r in apply_quantile_bins(attach_row(df, edges), "x", None, "b").collect()], edges.first()["edges"]


def test_quantile_bins_duplicates_and_edges(spark):
    got, edges = _bins(spark, [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, None])
    assert edges == sorted(set(edges))  # duplicates merged
    assert got[-1] == "Bin_Missing"
    # a value equal to an edge falls in the bin that edge closes (right-closed)
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    got2, edges2 = _bins(spark, vals)
    assert edges2 == [2.0, 3.0, 4.0, 5.0]  # quintile edges of 1..6, outer values dropped
    assert got2 == ["Bin_1", "Bin_1", "Bin_2", "Bin_3", "Bin_4", "Bin_5"]


def test_quantile_bins_one_value_and_all_null(spark):
    got, edges = _bins(spark, [3.0, 3.0, 3.0])
    assert edges == [] and set(got) == {"Bin_1"}
    got, edges = _bins(spark, [None, None])
    assert set(got) == {"Bin_Missing"}


def test_age_bins_left_closed(spark):
    vals = [-1.0, 0.0, 12.9, 13.0, 18.0, 60.0, 101.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    got = [r.g for r in df.select(age_group(F.col("a")).alias("g")).collect()]
    assert got == ["Unknown", "Child", "Child", "Teen", "YoungAdult", "Senior", "Senior", "Unknown"]


def test_percent_rank_average_ties(spark):
    rows = [("g", 1.0), ("g", 2.0), ("g", 2.0), ("g", 3.0), ("g", 3.0), ("g", 3.0), ("h", 5.0), ("h", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    out = sorted((r.k, r.x, r.p) for r in FE.percent_rank_avg(df, ["k"], "x", "p").collect() if r.x is not None)
    # pandas rank(method="average", pct=True): ranks 1, 2.5, 2.5, 5, 5, 5 over 6
    assert [round(p, 6) for _, _, p in out[:6]] == [round(v / 6, 6) for v in (1, 2.5, 2.5, 5, 5, 5)]
    assert out[6][2] == 1.0  # a group of one


def test_lower_quantile_differs_from_percentile_disc(spark):
    df = spark.createDataFrame([(v,) for v in (10.0, 20.0, 30.0, 40.0)], "x double")
    got = PR.lower_quantile(df, "x", 0.3).first()["value"]
    assert got == 10.0  # index floor(0.3 * 3) = 0
    disc = df.selectExpr("percentile_disc(0.3) WITHIN GROUP (ORDER BY x) AS v").first()["v"]
    assert disc == 20.0


def test_rank01_stable(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.1)], "id string, s double")
    got = {r.id: r.rank01 for r in FE.rank01(df, "s", "id").collect()}
    assert got == {"c": 0.0, "a": 0.5, "b": 1.0}


def test_exact_quantiles_match_percentile_with_hot_values(spark):
    rows = [("hot", 0.0 if i % 10 else float(i % 17) + i / 1000.0) for i in range(400)] + [("cold", 1.0), ("cold", 4.0), (None, 2.0), (None, None)]
    df = spark.createDataFrame(rows, "k string, x double")
    want = {r.k: (r.p[0], r.p[1]) for r in df.groupBy("k").agg(F.percentile("x", F.array(F.lit(0.5), F.lit(0.97))).alias("p")).collect()
            if r.p is not None}
    got = {r.k: (r.q0, r.q1, r.n) for r in PR.exact_quantiles(df, ["x"], [0.5, 0.97], by=["k"]).collect()}
    assert set(got) == set(want) and got["hot"][2] == 400
    for k in want:
        assert abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 1e-9
    glob = PR.exact_quantiles(df, ["x"], [0.5]).first()
    assert abs(glob.q0 - df.agg(F.median("x")).first()[0]) < 1e-9


def test_histogram_counts_rows_of_a_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, x double")
    got = PR.histogram(df, "x", 2, by=["k"]).collect()
    assert sum(r.n for r in got) == 3 and sum(r.n for r in got if r.k is None) == 2


def test_histogram_and_box_stats_of_few_groups_leave_the_rows_in_place(spark):
    rows = [(c, float(i % 40)) for c in ("a", "b", None) for i in range(200)] + [("a", None), ("b", 1000.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (PR.histogram(df, "x", 4, by=["g"]), PR.box_stats(df, "x", by=["g"]).select("g", "n", "median", "outliers")):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan
            found = {(r[0], r[1]): r for r in out.collect()}
            if "bin" in out.columns:
                assert "SortMergeJoin" not in plan
                assert found[None, 0].n == 50 and found["b", 0].n == 200 and found["b", 3].n == 1 and len(found) == 4 + 4 + 2
            else:
                assert found["b", 201].outliers == 1 and found[None, 200].median == 19.5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
