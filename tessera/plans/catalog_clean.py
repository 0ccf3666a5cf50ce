"""Queries of SURVEY §2.B (projection, cleaning, coercion, predicates) and §2.C (key parsing).

Every query is one projection (or a filter) over fixture W: no shuffle
beyond the fixture itself, all expressions built-in.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import clean as CL
from tessera.operators import features as FE
from tessera.operators import profile as PR
from tessera.operators.binning import apply_quantile_bins, fit_quantile_edges
from tessera.operators.core import attach_row, materialize
from tessera.operators.features import FEATURE_SETS, EXTRA_MODES, feature_columns, extra_columns
from tessera.plans import common_frame as CF
from tessera.plans.catalog_encode import _bin_sql, _edges_sql
from tessera.plans.common_frame_sql import COMMON_FRAME_SQL
from tessera.plans.registry import register
from tessera.plans.sqlparts import keyed, with_wk
from tessera.plans.util import rounded
from tessera.sources.fixtures import AMOUNTS, predictions, wide

# ------------------------------------------------------------------ SQL helpers


def sql_clean(c: str) -> str:
    return f"nullif(trim({c}, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)), '')"


def sql_bool(c: str) -> str:
    s = f"lower(trim(CAST({c} AS VARCHAR)))"
    return f"CASE WHEN {s} IN ('true','1','yes') THEN 'True' WHEN {s} IN ('false','0','no') THEN 'False' END"


def sql_last_token(c: str) -> str:
    return f"CASE WHEN trim({c}) = '' THEN NULL ELSE regexp_split_to_array(trim({c}), '\\s+')[-1] END"


# ------------------------------------------------------------------ 2.B


@register(
    "b_blank_to_null", "B1",
    sql=f"SELECT id, {sql_clean('home')} AS home, {sql_clean('dest')} AS dest, {sql_clean('code')} AS code, "
        f"{sql_clean('name')} AS name, {sql_clean('vip')} AS vip, {sql_clean('flag')} AS flag FROM w",
)
def b_blank_to_null(spark, sf_dir):
    w = wide(spark, sf_dir).select("id", "home", "dest", "code", "name", "vip", "flag")
    return CL.clean_strings(w)


@register(
    "b_blank_to_null_text", "B1",
    sql=f"SELECT conv_id, turn, {sql_clean('role')} AS role, {sql_clean('text')} AS text FROM conversations",
    fixtures=(),
)
def b_blank_to_null_text(spark, sf_dir):
    """B1 on the whole conversation texts (real leading/trailing whitespace and blank turns)."""
    from tessera.sources.tables import table

    return CL.clean_strings(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@register(
    "b_bool_normalize", "B2",
    sql=f"SELECT id, {sql_bool('vip')} AS vip, {sql_bool('flag')} AS flag, {sql_bool('y')} AS y FROM w",
)
def b_bool_normalize(spark, sf_dir):
    w = wide(spark, sf_dir).select("id", "vip", "flag", F.col("y").cast("string").alias("y"))
    return CL.normalize_booleans(w, ["vip", "flag", "y"])


@register(
    "b_bool_strict", "B3",
    sql="SELECT id, " + ", ".join(
        f"CASE WHEN lower(trim({c})) = 'true' THEN 1.0 WHEN lower(trim({c})) = 'false' THEN 0.0 END AS {c}"
        for c in ("vip", "flag")
    ) + " FROM w",
)
def b_bool_strict(spark, sf_dir):
    return CL.coerce_booleans_strict(wide(spark, sf_dir).select("id", "vip", "flag"), ["vip", "flag"])


_BUCKET_SQL = (
    "CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'Missing' WHEN lower(trim({c})) IN ('true', '1', 'yes', 'y') THEN 'True' "
    "WHEN lower(trim({c})) IN ('false', '0', 'no', 'n') THEN 'False' ELSE 'Other' END"
)


@register(
    "b_bool_bucket", "B4",
    sql="SELECT column_name, bucket, count(*) AS n FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {_BUCKET_SQL.format(c=c)} AS bucket FROM w" for c in ("vip", "flag", "home")
        )
        + ") t GROUP BY column_name, bucket",
)
def b_bool_bucket(spark, sf_dir):
    """True/False/Missing/Other counts of three raw columns (one unpivot, one aggregate)."""
    w = wide(spark, sf_dir).select("vip", "flag", "home")
    long = w.unpivot([], ["vip", "flag", "home"], "column_name", "raw")
    return long.groupBy("column_name", C.bool_bucket("raw").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "b_numeric_coerce", "B5",
    sql="SELECT id, TRY_CAST(split_part(code, '/', 2) AS DOUBLE) AS size_num, TRY_CAST(dest AS DOUBLE) AS dest_num, "
        "TRY_CAST(member_no AS DOUBLE) AS member_num FROM w",
)
def b_numeric_coerce(spark, sf_dir):
    w = wide(spark, sf_dir).select(
        "id",
        F.get(F.split("code", "/"), 1).alias("size_num"),
        F.col("dest").alias("dest_num"),
        F.col("member_no").cast("string").alias("member_num"),
    )
    return CL.coerce_numeric(w, ["size_num", "dest_num", "member_num"])


@register("b_label_coerce", "B6", sql="SELECT id, CAST(y AS INTEGER) AS y FROM w WHERE split = 'train'")
def b_label_coerce(spark, sf_dir):
    w = wide(spark, sf_dir).filter(F.col("split") == "train").select("id", F.col("y").cast("string").alias("y"))
    return CL.coerce_label(w, "y")


@register(
    "b_pred_coerce", "B7",
    sql="SELECT id, family, p >= 0.5 AS pred FROM p",
    fixtures=("p",),
)
def b_pred_coerce(spark, sf_dir):
    p = predictions(spark, sf_dir).select("id", "family", F.when(F.col("p") >= 0.5, "True").otherwise("False").alias("pred"))
    return CL.coerce_predictions(p, "pred")


def _feature_set_sql(branch: str) -> str:
    return "SELECT " + ", ".join(["id", *feature_columns(branch)]) + " FROM w"


for _branch in FEATURE_SETS:
    def _make(branch):
        def q(spark, sf_dir):
            return rounded(wide(spark, sf_dir).select("id", *feature_columns(branch)))
        return q

    register(f"b_feature_set_{_branch}", "B8", sql=_feature_set_sql(_branch))(_make(_branch))


_SPEC_NUMERIC, _SPEC_AUDIT = ["age", *AMOUNTS, "member_no"], ["id", "y", "split"]


@register(
    "b_feature_spec", "B8",
    sql=" UNION ALL ".join(
        f"SELECT '{b}' AS branch, '{c}' AS column_name, '{r}' AS role, {i} AS place, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM w"
        for b in FEATURE_SETS for r, cs in FE.feature_spec(b, [*_SPEC_AUDIT, *FE.EVERY_FEATURE]).items() for i, c in enumerate(cs)
    ),
)
def b_feature_spec(spark, sf_dir):
    """Of every branch the numeric, categorical and dropped columns of the table in order, with their nulls (a column that isn't there raises)."""
    w = wide(spark, sf_dir)
    rows = [(b, c, r, i) for b in FEATURE_SETS for r, cs in FE.feature_spec(b, [*_SPEC_AUDIT, *[c for c in w.columns if c not in _SPEC_AUDIT]]).items() for i, c in enumerate(cs)]
    spec = spark.createDataFrame(rows, "branch string, column_name string, role string, place int")
    nulls = PR.null_counts(w, w.columns).select("column_name", "nulls")
    return spec.join(nulls, "column_name").select("branch", "column_name", "role", "place", "nulls")


_SWITCHED = {"include_spend": False, "include_surname": True, "no_such_option": True}


def _options_sql(options) -> str:
    names = FE.optional_columns(FE.resolve_options(options))
    return "SELECT id, " + ", ".join(names) + " FROM (" + COMMON_FRAME_SQL + ") cf"


@register("b_feature_options", "B9", sql=_options_sql(None))
def b_feature_options(spark, sf_dir):
    """The boosted-tree branch with the default switches: all families but the surname itself."""
    cf = rounded(CF.build(wide(spark, sf_dir)))
    return cf.select("id", *FE.optional_columns(FE.resolve_options(None)))


@register("b_feature_switches", "B9", sql=_options_sql(_SWITCHED))
def b_feature_switches(spark, sf_dir):
    """The spend family off and the surname on; an unknown option is ignored."""
    cf = rounded(CF.build(wide(spark, sf_dir)))
    return cf.select("id", *FE.optional_columns(FE.resolve_options(_SWITCHED)))


_VIEW_DROP = ["name", "code", "a5", "not_a_column"]


@register(
    "b_feature_view", "B10",
    sql="SELECT member_no, id, home, dest, vip, flag, age, a1, a2, a3, a4, y, split FROM w",
)
def b_feature_view(spark, sf_dir):
    return rounded(CL.drop_present(wide(spark, sf_dir), _VIEW_DROP))


for _mode in EXTRA_MODES:
    def _make_mode(mode):
        def q(spark, sf_dir):
            w = wide(spark, sf_dir)
            return rounded(w.select("id", *[e.alias(n) for n, e in extra_columns(mode).items()]))
        return q

    from tessera.operators.features import extra_columns_sql as _ecs

    register(
        f"b_extra_mode_{_mode}", "B11",
        sql="SELECT " + ", ".join(["id", *[f"round({e}, 6) AS {n}" for n, e in _ecs(_mode).items()]]) + " FROM w",
    )(_make_mode(_mode))


@register(
    "b_minimal_clean", "B12",
    sql="""
    SELECT id, split, split_part(code, '/', 1) AS deck,
           TRY_CAST(nullif(split_part(code, '/', 2), '') AS DOUBLE) AS num,
           CASE WHEN len(string_split(code, '/')) >= 3 THEN array_to_string(string_split(code, '/')[3:], '/') END AS side,
           round(coalesce(age, (SELECT median(age) FROM w)), 6) AS age
    FROM w""",
)
def b_minimal_clean(spark, sf_dir):
    """Drop the name, split the code, fill age by its median (one scalar aggregate)."""
    w = wide(spark, sf_dir).drop("name")
    from tessera.operators.profile import exact_quantiles

    med = exact_quantiles(w, ["age"], [0.5]).select(F.col("q0").alias("m"))
    d, n, s = C.split_code("code")
    out = attach_row(w, med).select(
        "id", "split", d.alias("deck"), n.alias("num"), s.alias("side"), F.coalesce("age", "m").alias("age")
    )
    return rounded(out)


@register(
    "b_predicates", "B13",
    sql="""
    SELECT id, coalesce(a1 > 0, false) AS a1_pos, home IN ('ASIA', 'EUROPE') AS home_in,
           age BETWEEN 18 AND 60 AS adult, coalesce(vip = 'True', false) AS is_vip
    FROM w WHERE a2 > 0 AND split = 'train'""",
)
def b_predicates(spark, sf_dir):
    """Filters (null is not true) and null-as-false flags in a projection."""
    w = wide(spark, sf_dir)
    return w.filter((F.col("a2") > 0) & (F.col("split") == "train")).select(
        "id",
        F.coalesce(F.col("a1") > 0, F.lit(False)).alias("a1_pos"),
        F.col("home").isin("ASIA", "EUROPE").alias("home_in"),
        F.col("age").between(18, 60).alias("adult"),
        F.coalesce(F.col("vip") == "True", F.lit(False)).alias("is_vip"),
    )


# ------------------------------------------------------------------ 2.C


@register(
    "c_split_id", "C1",
    sql="SELECT id, split_part(id, '_', 1) AS group_id, "
        "TRY_CAST(CASE WHEN strpos(id, '_') > 0 THEN substr(id, strpos(id, '_') + 1) END AS INTEGER) AS member FROM w",
)
def c_split_id(spark, sf_dir):
    return CL.with_id_parts(wide(spark, sf_dir).select("id"), "id", "group_id", "member")


@register(
    "c_group_fixed_width", "C2",
    sql="SELECT id, TRY_CAST(left(id, greatest(length(id) - 3, 0)) AS BIGINT) AS group_num, "
        "substr(id, 1, 4) AS group_prefix FROM w",
)
def c_group_fixed_width(spark, sf_dir):
    return wide(spark, sf_dir).select("id", *C.fixed_width_group("id"))


@register(
    "c_split_code", "C3",
    sql="SELECT id, split_part(code, '/', 1) AS deck, "
        "TRY_CAST(nullif(split_part(code, '/', 2), '') AS DOUBLE) AS num, "
        "CASE WHEN len(string_split(code, '/')) >= 3 THEN array_to_string(string_split(code, '/')[3:], '/') END AS side "
        "FROM w",
)
def c_split_code(spark, sf_dir):
    return CL.with_code_parts(wide(spark, sf_dir).select("id", "code"), "code").drop("code")


@register("c_last_token", "C4", sql=f"SELECT id, {sql_last_token('name')} AS surname FROM w")
def c_last_token(spark, sf_dir):
    return CL.with_last_token(wide(spark, sf_dir).select("id", "name"), "name").drop("name")


@register(
    "c_last_token_lower", "C5",
    sql=f"SELECT id, coalesce(lower({sql_last_token('name')}), 'no_name') AS surname FROM w",
)
def c_last_token_lower(spark, sf_dir):
    return wide(spark, sf_dir).select("id", C.last_token_lower("name").alias("surname"))


@register(
    "c_lookup_key", "C6",
    sql="SELECT id, to_json([coalesce(home, '__MISSING__'), coalesce(dest, '__MISSING__'), "
        "coalesce(vip, '__MISSING__')]) AS level_key FROM w",
)
def c_lookup_key(spark, sf_dir):
    return wide(spark, sf_dir).select("id", C.lookup_key("home", "dest", "vip").alias("level_key"))


@register(
    "c_interaction_key", "C7",
    sql="SELECT id, coalesce(home, 'Unknown') || '_' || coalesce(dest, 'Unknown') AS home_dest, "
        "coalesce(vip, 'Unknown') || '_' || coalesce(flag, 'Unknown') AS vip_flag FROM w",
)
def c_interaction_key(spark, sf_dir):
    w = wide(spark, sf_dir)
    return w.select("id", C.interaction_key("home", "dest").alias("home_dest"), C.interaction_key("vip", "flag").alias("vip_flag"))


_C8 = {
    "deck_numbin": ("deck", "num_bin"),
    "deck_dest": ("deck", "dest"),
    "home_deck": ("home", "deck"),
    "home_dest": ("home", "dest"),
    "flag_nospend": ("flag", "no_spend"),
    "group_surname": ("group_id", "surname"),
}


@register(
    "c_interaction_more", "C8",
    sql=with_wk(f"""
    WITH e AS ({_edges_sql("num", "(SELECT * FROM wk WHERE split = 'train') tr")}),
    b AS (SELECT id, home, dest, flag, deck, {_bin_sql("num")} AS num_bin, CAST(total = 0 AS INTEGER) AS no_spend, group_id, surname FROM wk, e)
    SELECT id, """ + ", ".join(
        f"coalesce(CAST({a} AS VARCHAR), 'Unknown') || '_' || coalesce(CAST({b} AS VARCHAR), 'Unknown') AS {n}"
        for n, (a, b) in _C8.items()
    ) + " FROM b"),
)
def c_interaction_more(spark, sf_dir):
    """Interaction keys, the number by its quantile bin (J1) of the train rows."""
    w = materialize(keyed(wide(spark, sf_dir)), "keyed")
    edges = fit_quantile_edges(w, "num", 5, fit_on=F.col("split") == "train")
    b = apply_quantile_bins(attach_row(w, edges), "num", None, "num_bin").withColumn("no_spend", (F.col("total") == 0).cast("int"))
    return b.select("id", *[C.interaction_key(a, bb).alias(k) for k, (a, bb) in _C8.items()])
