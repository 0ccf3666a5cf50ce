from pyspark.sql import functions as F

from tessera.operators import impute as IM
from tessera.plans.common_frame import Roles


def test_group_consistent_fill(spark):
    rows = [("g1", "A"), ("g1", None), ("g2", "A"), ("g2", "B"), ("g2", None), ("g3", None), ("g4", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    out = IM.group_consistent_fill(df, "g", ["v"]).orderBy("g", F.col("v").asc_nulls_last()).collect()
    got = [(r.g, r.v, r.v_group_filled) for r in out]
    assert ("g1", "A", 1) in got and got.count(("g1", "A", 0)) == 1
    assert ("g2", None, 0) in got and ("g3", None, 0) in got and ("g4", None, 0) in got


def test_mode_ties_lowest_and_cascade(spark):
    rows = [(1, "a", "x", "B"), (2, "a", "x", "A"), (3, "a", "x", None), (4, "b", "y", None), (5, "c", None, None)]
    df = spark.createDataFrame(rows, "i int, g string, s string, v string")
    out = {r.i: r.v for r in IM.cascade_mode_fill(df, "v", ["g", "s"]).collect()}
    assert out[3] == "A"  # tie between A and B -> lowest
    assert out[4] == "A" and out[5] == "A"  # no group value -> global mode (tie -> lowest)


def test_hier_median_cases(spark):
    r = Roles(amounts=["a1", "a2"])
    levels = [["k1", "k2"], ["k1"]]
    rows = [
        # train rows that define the statistics
        ("t1", "train", "A", "x", "False", 10.0, 1.0),
        ("t2", "train", "A", "x", "False", 20.0, 3.0),
        ("t3", "train", "A", "y", "False", 40.0, 0.0),
        ("t4", "train", None, "z", "False", 7.0, 5.0),
        # rows to fill
        ("m1", "test", "A", "x", "False", None, 2.0),   # level 1 match
        ("m2", "test", "A", "q", "False", None, 0.0),   # level 2 match
        ("m3", "test", "B", "q", "False", None, 5.0),   # no level, other amount > 0 -> positive median
        ("m4", "test", "B", "q", "False", None, 0.0),   # no level, no other amount -> global median
        ("m5", "test", "B", "q", "True", None, 0.0),    # flag True -> 0
        ("m6", "test", None, "z", "False", None, 0.0),  # null key is a level
    ]
    df = spark.createDataFrame(rows, "id string, split string, k1 string, k2 string, flag string, a1 double, a2 double")
    stats = IM.fit_hier_medians(df, ["a1", "a2"], levels, fit_on=F.col("split") == "train")
    out = {x.id: (x.a1, x.a1_fill) for x in IM.apply_hier_medians(df, stats, "flag").collect()}
    assert out["m1"] == (15.0, "level1")
    assert out["m2"] == (20.0, "level2")
    assert out["m3"] == (15.0, "positive")  # positive-only train median of a1: median(10, 20, 40, 7)
    assert out["m4"][1] == "global"
    assert out["m5"] == (0.0, "zero")
    assert out["m6"] == (7.0, "level1")


def test_infer_flag_rules(spark):
    rows = [(None, 20.0, 0.0, 3.0), (None, 30.0, 0.0, 0.0), (None, 10.0, 0.0, 0.0), (None, 30.0, None, 0.0), ("True", 30.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "flag string, age double, a1 double, a2 double")
    out = [(r.flag, r.flag_rule) for r in IM.infer_flag(df, "flag", ["a1", "a2"], "age").collect()]
    assert out[0] == ("False", "positive_to_false")
    assert out[1] == ("True", "adult_zero_to_true")
    assert out[2] == (None, None)  # child
    assert out[3] == (None, None)  # an amount unknown
    assert out[4] == ("True", None)


def test_range_guard(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (100.0,), (101.0,), (None,)], "age double")
    out = [(r.age, r.f) for r in IM.range_guard(df, "age", 0, 100, "f").collect()]
    assert out == [(None, 1), (0.0, 0), (100.0, 0), (None, 1), (None, 0)]


def test_group_fill_counts_the_rows_of_a_key_over_all_groups(spark):
    rows = [("tr", "g1", "a"), ("tr", "g1", None), ("te", "g1", "b"), ("te", "g2", None), ("te", None, "c"), (None, "g2", "d")]
    df = spark.createDataFrame(rows, "split string, g string, v string")
    out = IM.group_consistent_fill(df, ["split", "g"], ["v"], sizes={"g": "n"})
    found = sorted((r.split or "", r.g or "", r.v or "", r.n) for r in out.collect())
    assert found == [("", "g2", "d", 2), ("te", "", "c", None), ("te", "g1", "b", 3), ("te", "g2", "", 2), ("tr", "g1", "a", 3), ("tr", "g1", "a", 3)]


def test_common_frame_is_not_shuffled_by_surname_or_group_again(spark):
    from conftest import SMOKE
    from tessera.plans import common_frame as CF
    from tessera.sources.fixtures import wide

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = CF.build(wide(spark, SMOKE))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(surname" not in plan and "hashpartitioning(group_id" not in plan
