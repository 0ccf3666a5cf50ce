"""Queries of SURVEY §2.D (missing data) and the flagship common frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import impute as IM
from tessera.operators.core import lookup, settled
from tessera.plans import common_frame as CF
from tessera.plans.common_frame_sql import APPLY_SQL, COMMON_FRAME_SQL, PREPARE_SQL, STATS_SQL
from tessera.plans.registry import register
from tessera.plans.util import rounded
from tessera.sources.fixtures import AMOUNTS, wide

A = AMOUNTS
INDICATORS = ["age", "home", "flag", "code", "dest", "vip", *A, "name"]


@register("d_common_frame", "D12-D14", sql=COMMON_FRAME_SQL)
def d_common_frame(spark, sf_dir):
    """Flagship: the whole common frame of W (train-fit statistics applied to both splits)."""
    return rounded(CF.build(wide(spark, sf_dir)).select(*CF.OUTPUT_COLUMNS))


@register(
    "d_missing_indicators", "D1",
    sql="SELECT id, " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}Missing" for c in INDICATORS) + " FROM w",
)
def d_missing_indicators(spark, sf_dir):
    return IM.missing_indicators(wide(spark, sf_dir), INDICATORS).select("id", *[f"{c}Missing" for c in INDICATORS])


@register(
    "d_missing_count", "D2",
    sql="SELECT id, " + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in INDICATORS) + " AS missing_count, "
        + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in A) + " AS amount_missing FROM w",
)
def d_missing_count(spark, sf_dir):
    w = IM.missing_count(wide(spark, sf_dir), INDICATORS)
    return IM.missing_count(w, A, "amount_missing").select("id", "missing_count", "amount_missing")


_GF = ["home", "vip", "dest"]


@register(
    "d_group_fill", "D3",
    sql="""
    WITH b AS (SELECT *, split_part(id, '_', 1) AS group_id FROM w),
    g AS (SELECT split, group_id, """ + ", ".join(
        f"CASE WHEN min({c}) = max({c}) THEN min({c}) END AS f_{c}" for c in _GF) + """
          FROM b GROUP BY split, group_id)
    SELECT id, """ + ", ".join(f"coalesce(b.{c}, f_{c}) AS {c}" for c in _GF) + ", " + ", ".join(
        f"CAST(b.{c} IS NULL AND f_{c} IS NOT NULL AS INTEGER) AS {c}_group_filled" for c in _GF) + """
    FROM b JOIN g ON b.split = g.split AND b.group_id = g.group_id""",
)
def d_group_fill(spark, sf_dir):
    """D3: group-consistent fill within each split (group = id prefix)."""
    w = wide(spark, sf_dir).withColumn("group_id", C.split_id("id")[0])
    out = IM.group_consistent_fill(w, ["split", "group_id"], _GF)
    return out.select("id", *_GF, *[f"{c}_group_filled" for c in _GF])


@register(
    "d_group_fill_trainfit", "D4",
    sql="""
    WITH g AS (SELECT code, CASE WHEN min(dest) = max(dest) THEN min(dest) END AS f_dest,
                      CASE WHEN min(home) = max(home) THEN min(home) END AS f_home
               FROM w WHERE split = 'train' GROUP BY code)
    SELECT id, split, coalesce(w.dest, f_dest) AS dest, coalesce(w.home, f_home) AS home,
           CAST(w.dest IS NULL AND f_dest IS NOT NULL AS INTEGER) AS dest_group_filled,
           CAST(w.home IS NULL AND f_home IS NOT NULL AS INTEGER) AS home_group_filled
    FROM w LEFT JOIN g ON w.code IS NOT DISTINCT FROM g.code""",
)
def d_group_fill_trainfit(spark, sf_dir):
    """The fill map is fitted on train rows (key = code) and applied to every row."""
    w = wide(spark, sf_dir)
    out = IM.group_consistent_fill(w, "code", ["dest", "home"], fit_on=F.col("split") == "train")
    return out.select("id", "split", "dest", "home", "dest_group_filled", "home_group_filled")


def _sql_mode_step(src: str, key: str, col: str) -> str:
    """One cascade level: the mode (ties -> lowest) of ``col`` per non-null ``key`` of ``src``."""
    return f"""(SELECT {key}, {col} AS m FROM (
        SELECT {key}, {col}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {col}) AS rn
        FROM {src} WHERE {col} IS NOT NULL AND {key} IS NOT NULL GROUP BY {key}, {col}) t WHERE rn = 1)"""


def _cascade_sql(col: str, keys: list[str], agg: str) -> str:
    """Sequential fills: each level reads the output of the previous one."""
    ctes = ["s0 AS (SELECT id, split_part(id, '_', 1) AS group_id, "
            "CASE WHEN trim(name) = '' THEN NULL ELSE regexp_split_to_array(trim(name), '\\s+')[-1] END AS surname, "
            f"code, {col} FROM w)"]
    for i, k in enumerate(keys):
        if agg == "mode":
            stat = _sql_mode_step(f"s{i}", k, col)
        else:
            stat = f"(SELECT {k}, median({col}) AS m FROM s{i} WHERE {k} IS NOT NULL GROUP BY {k})"
        ctes.append(
            f"s{i + 1} AS (SELECT s{i}.* REPLACE (coalesce(s{i}.{col}, st.m) AS {col}) "
            f"FROM s{i} LEFT JOIN {stat} st ON s{i}.{k} = st.{k})"
        )
    n = len(keys)
    if agg == "mode":
        glob = f"(SELECT {col} FROM s{n} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"
        out = f"coalesce({col}, {glob})"
    else:
        out = f"round(coalesce({col}, (SELECT median({col}) FROM s{n})), 6)"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id, {out} AS {col} FROM s{n}"


@register("d_mode_cascade", "D5", sql=_cascade_sql("home", ["group_id", "surname"], "mode"))
def d_mode_cascade(spark, sf_dir):
    """Home filled by the mode of the group, then of the surname, then globally."""
    w = wide(spark, sf_dir)
    g, _ = C.split_id("id")
    b = w.select("id", g.alias("group_id"), C.last_token("name").alias("surname"), "code", "home")
    return IM.cascade_mode_fill(b, "home", ["group_id", "surname"]).select("id", "home")


@register("d_median_cascade", "D6", sql=_cascade_sql("age", ["code", "surname"], "median"))
def d_median_cascade(spark, sf_dir):
    """Age filled by the median per code, then per surname (on the filled values), then globally."""
    w = wide(spark, sf_dir)
    g, _ = C.split_id("id")
    b = w.select("id", g.alias("group_id"), C.last_token("name").alias("surname"), "code", "age")
    return rounded(IM.cascade_median_fill(b, "age", ["code", "surname"]).select("id", "age"))


@register(
    "d_first_seen_fill", "D7",
    sql="""
    WITH b AS (SELECT id, substr(id, 1, 4) AS room, home, vip FROM w),
    gh AS (SELECT room, arg_min(home, id) AS fh FROM b WHERE home IS NOT NULL GROUP BY room),
    gv AS (SELECT room, arg_min(vip, id) AS fv FROM b WHERE vip IS NOT NULL GROUP BY room)
    SELECT id, room, coalesce(home, fh) AS home, coalesce(vip, fv) AS vip
    FROM b LEFT JOIN gh USING (room) LEFT JOIN gv USING (room)""",
)
def d_first_seen_fill(spark, sf_dir):
    """Null filled from the first non-null row of the room (room = first 4 id characters, order = id)."""
    b = wide(spark, sf_dir).select("id", F.substring("id", 1, 4).alias("room"), "home", "vip")
    b = IM.first_seen_fill(b, "room", "home", "id")
    return IM.first_seen_fill(b, "room", "vip", "id")


_ANY_POS = " OR ".join(f"coalesce({a} > 0, false)" for a in A)
_SUM = " + ".join(f"coalesce({a}, 0.0)" for a in A)


@register(
    "d_infer_flag", "D8",
    sql=f"""
    WITH b AS (SELECT *, CASE
        WHEN flag IS NULL AND ({_ANY_POS}) THEN 'positive_to_false'
        WHEN flag IS NULL AND age IS NOT NULL AND age >= 18.0 AND {" AND ".join(f"{a} IS NOT NULL" for a in A)}
             AND ({_SUM}) = 0 THEN 'adult_zero_to_true' END AS flag_rule FROM w)
    SELECT id, flag_rule, CASE WHEN flag_rule = 'positive_to_false' THEN 'False'
                               WHEN flag_rule = 'adult_zero_to_true' THEN 'True' ELSE flag END AS flag
    FROM b""",
)
def d_infer_flag(spark, sf_dir):
    return IM.infer_flag(wide(spark, sf_dir), "flag", A, "age").select("id", "flag_rule", "flag")


@register(
    "d_infer_flag_counts", "D8",
    sql=f"""
    SELECT coalesce(rule, 'none') AS rule, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT CASE WHEN flag IS NULL AND ({_ANY_POS}) THEN 'positive_to_false'
        WHEN flag IS NULL AND age IS NOT NULL AND age >= 18.0 AND {" AND ".join(f"{a} IS NOT NULL" for a in A)}
             AND ({_SUM}) = 0 THEN 'adult_zero_to_true' END AS rule FROM w) t GROUP BY rule""",
)
def d_infer_flag_counts(spark, sf_dir):
    """D8 fill counts by rule (the counts the reference returns with the frame)."""
    out = IM.infer_flag(wide(spark, sf_dir), "flag", A, "age")
    return out.groupBy(F.coalesce("flag_rule", F.lit("none")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "d_infer_flag_loose", "D9",
    sql=f"""
    SELECT id, coalesce(flag, CASE WHEN ({_SUM}) = 0 THEN 'True' ELSE 'False' END) AS flag_fill,
           CASE WHEN ({_SUM}) = 0 THEN 'True' ELSE 'False' END AS flag_overwrite,
           CASE WHEN ({_SUM}) = 0 THEN 'False' ELSE 'True' END AS vip_overwrite, {", ".join(f"round(coalesce({a}, 0.0), 6) AS {a}" for a in A)}
    FROM w""",
)
def d_infer_flag_loose(spark, sf_dir):
    """Loose fill, and the overwrite variant (flag = total == 0, vip = not flag, null amounts 0) in one projection."""
    w = wide(spark, sf_dir)
    both = IM.infer_flag_loose(w, "flag", A)
    both = IM.infer_flag_loose(both.withColumn("flag_fill", F.col("flag")), "flag", A, overwrite=True)
    return rounded(both.select("id", "flag_fill", F.col("flag").alias("flag_overwrite"),
                               F.when(F.col("flag") == "True", "False").otherwise("True").alias("vip_overwrite"), *A))


@register(
    "d_enforce_flag_zero", "D10",
    sql="SELECT id, " + ", ".join(
        f"round(CASE WHEN coalesce(flag = 'True', false) THEN 0.0 ELSE {a} END, 6) AS {a}" for a in A) + " FROM w",
)
def d_enforce_flag_zero(spark, sf_dir):
    return rounded(IM.enforce_flag_zero(wide(spark, sf_dir), "flag", A).select("id", *A))


@register(
    "d_range_guard", "D11",
    sql="SELECT id, CASE WHEN age < 0 OR age > 100 THEN NULL ELSE age END AS age, "
        "CAST(coalesce(age < 0 OR age > 100, false) AS INTEGER) AS age_out_of_range FROM w",
)
def d_range_guard(spark, sf_dir):
    return IM.range_guard(wide(spark, sf_dir), "age", 0.0, 100.0, "age_out_of_range").select("id", "age", "age_out_of_range")


def _levels_long_sql() -> str:
    parts = []
    for i, keys in enumerate(CF.Roles().levels):
        key = "to_json([" + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '__MISSING__')" for k in keys) + "])"
        meds = ", ".join(f"round(median({a}), 6) AS med_{a}" for a in A)
        parts.append(
            f"SELECT {i + 1} AS level, {key} AS level_key, CAST(count(*) AS BIGINT) AS n, {meds} "
            f"FROM s7 WHERE split = 'train' GROUP BY {', '.join(keys)}"
        )
    return "WITH " + PREPARE_SQL.strip() + "\n" + " UNION ALL ".join(parts)


def _amounts_prepared(spark, sf_dir, r):
    """The prepared rows, written with the columns that the level medians and their apply read."""
    used = dict.fromkeys([r.id, r.split, r.flag, *[k for keys in r.levels for k in keys], *A])
    return settled(lambda: CF.prepared(wide(spark, sf_dir), r).select(*used), "prepared")


@register("d_hier_median_fit", "D12", sql=_levels_long_sql())
def d_hier_median_fit(spark, sf_dir):
    """The fitted level medians of every amount, one row per (level, key); null key = own level."""
    r = CF.Roles()
    # what the medians read; other columns are not written
    train = settled(lambda: CF.prepared(wide(spark, sf_dir), r).filter(F.col("split") == "train").select(*dict.fromkeys(k for keys in r.levels for k in keys), *A), "prepared")
    from tessera.operators.profile import level_quantiles, level_table

    found = settled(lambda: level_quantiles(train, [(keys, A) for keys in r.levels], [0.5]), "medians")
    out = None
    for i, keys in enumerate(r.levels):
        cnt = train.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        t = lookup(cnt, level_table(found, i, keys, {a: f"med_{a}" for a in A}), keys, null_safe=True)
        t = t.select(F.lit(i + 1).alias("level"), C.lookup_key(*keys).alias("level_key"), "n", *[f"med_{a}" for a in A])
        out = t if out is None else out.unionByName(t)
    return rounded(out)


@register(
    "d_hier_median_apply", "D13",
    sql="WITH " + PREPARE_SQL.strip() + ",\n" + STATS_SQL + ",\n" + APPLY_SQL.strip().split(",\ns9 AS")[0]
        + "\nSELECT id, " + ", ".join(f"round({a}, 6) AS {a}, {a}_fill" for a in A) + " FROM s8",
)
def d_hier_median_apply(spark, sf_dir):
    """Amounts filled from the train-fit level medians (3 joins whatever the amount count)."""
    r = CF.Roles()
    df = _amounts_prepared(spark, sf_dir, r)  # four fits and the apply read it
    train = F.col("split") == "train"
    stats = IM.fit_hier_medians(df, A, r.levels, fit_on=train)
    out = IM.apply_hier_medians(df, stats, r.flag)
    return rounded(out.select("id", *[x for a in A for x in (a, f"{a}_fill")]))


@register(
    "d_hier_fill_counts", "D13",
    sql="WITH " + PREPARE_SQL.strip() + ",\n" + STATS_SQL + ",\n" + APPLY_SQL.strip().split(",\ns9 AS")[0]
        + "\nSELECT amount, kind, CAST(count(*) AS BIGINT) AS n FROM ("
        + " UNION ALL ".join(f"SELECT '{a}' AS amount, {a}_fill AS kind FROM s8" for a in A)
        + ") t GROUP BY amount, kind",
)
def d_hier_fill_counts(spark, sf_dir):
    """D13 fill counts by kind (zero / observed / level1-3 / positive / global)."""
    r = CF.Roles()
    df = _amounts_prepared(spark, sf_dir, r)
    stats = IM.fit_hier_medians(df, A, r.levels, fit_on=F.col("split") == "train")
    out = IM.apply_hier_medians(df, stats, r.flag)
    long = out.select(F.explode(F.array(*[F.struct(F.lit(a).alias("amount"), F.col(f"{a}_fill").alias("kind")) for a in A])).alias("s"))
    return long.groupBy("s.amount", "s.kind").agg(F.count(F.lit(1)).alias("n"))


_SIMPLE = {"mean": "avg({c})", "median": "median({c})"}


for _strategy in ("mean", "median"):
    def _mk(strategy):
        def q(spark, sf_dir):
            w = wide(spark, sf_dir)
            return rounded(IM.simple_impute(w, ["age", *A], strategy, fit_on=F.col("split") == "train").select("id", "age", *A))
        return q

    register(
        f"d_simple_impute_{_strategy}", "D15",
        sql="WITH s AS (SELECT " + ", ".join(f"{_SIMPLE[_strategy].format(c=c)} AS s_{c}" for c in ["age", *A])
            + " FROM w WHERE split = 'train') SELECT id, "
            + ", ".join(f"round(coalesce({c}, s_{c}), 6) AS {c}" for c in ["age", *A]) + " FROM w CROSS JOIN s",
    )(_mk(_strategy))


def _global_mode_sql(c: str) -> str:
    return (f"(SELECT {c} FROM w WHERE split = 'train' AND {c} IS NOT NULL "
            f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")


@register(
    "d_simple_impute_most_frequent", "D15",
    sql="SELECT id, " + ", ".join(f"coalesce({c}, {_global_mode_sql(c)}) AS {c}" for c in ["home", "dest", "vip", "flag"])
        + " FROM w",
)
def d_simple_impute_most_frequent(spark, sf_dir):
    w = wide(spark, sf_dir)
    cols = ["home", "dest", "vip", "flag"]
    return IM.simple_impute(w, cols, "most_frequent", fit_on=F.col("split") == "train").select("id", *cols)


@register(
    "d_post_fill", "D17",
    sql="SELECT id, coalesce(home, 'Unknown') AS home, coalesce(name, 'Unknown') AS name, "
        "round(CASE WHEN age IS NULL OR isnan(age) OR isinf(age) THEN 0.0 ELSE age END, 6) AS age, "
        "round(CASE WHEN a2 / a3 IS NULL OR isnan(a2 / a3) OR isinf(a2 / a3) THEN 0.0 ELSE a2 / a3 END, 6) AS ratio "
        "FROM (SELECT id, home, name, age, a2, CASE WHEN a3 = 0 THEN NULL ELSE a3 END AS a3 FROM w) t",
)
def d_post_fill(spark, sf_dir):
    """Unknown strings, numeric nulls and non-finite values to 0."""
    w = wide(spark, sf_dir).select(
        "id", "home", "name", "age", F.try_divide("a2", F.when(F.col("a3") == 0, None).otherwise(F.col("a3"))).alias("ratio")
    )
    return rounded(IM.post_fill(w, ["home", "name"], ["age", "ratio"]))
