"""Queries of SURVEY §2.G (group transforms and window functions).

The oracle side uses SQL windows; the Spark side uses aggregate + join
(:func:`features.group_transform`) so a hot group is combined map-side
instead of being sorted inside one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import features as FE
from tessera.operators import impute as IM
from tessera.operators.core import lookup
from tessera.plans.registry import register
from tessera.plans.sqlparts import keyed, sql_hash_bucket, with_wk
from tessera.plans.util import rounded
from tessera.sources.fixtures import predictions, wide


def _g1_aggs():
    return {
        "group_spend_mean": C.exact_mean("total"),
        "group_spend_max": F.max("total"),
        "group_age_mean": F.avg("age"),
        "group_zero_share": F.avg((F.col("total") == 0).cast("double")),
    }


def _emean(c: str, part: str) -> str:
    """Twin of ``columns.exact_mean`` as a window over ``part``."""
    return f"(CAST(sum(CAST({c} AS DECIMAL(38,4))) OVER (PARTITION BY {part}) AS DOUBLE) / count({c}) OVER (PARTITION BY {part}))"


def _g1_sql(part: str) -> str:
    return with_wk(f"""
    SELECT id, round({_emean("total", part)}, 6) AS group_spend_mean,
           round(max(total) OVER (PARTITION BY {part}), 6) AS group_spend_max,
           round(avg(age) OVER (PARTITION BY {part}), 6) AS group_age_mean,
           round(avg(CAST(total = 0 AS DOUBLE)) OVER (PARTITION BY {part}), 6) AS group_zero_share
    FROM wk""")


@register("g_group_transform", "G1", sql=_g1_sql("group_id"))
def g_group_transform(spark, sf_dir):
    """G1: group mean/max spend, mean age, zero-spend share attached to every row (combined scope)."""
    w = keyed(wide(spark, sf_dir))
    out = FE.group_transform(w, ["group_id"], _g1_aggs())
    return rounded(out.select("id", *_g1_aggs().keys()))


@register("g_group_transform_split", "G6", sql=_g1_sql("split, group_id"))
def g_group_transform_split(spark, sf_dir):
    """The same with the split-local scope (split is part of the key)."""
    w = keyed(wide(spark, sf_dir))
    out = FE.group_transform(w, ["split", "group_id"], _g1_aggs())
    return rounded(out.select("id", *_g1_aggs().keys()))


def _pct_sql(col: str, part: str) -> str:
    return (f"CASE WHEN {col} IS NULL OR {part} IS NULL THEN 0.5 ELSE round((rank() OVER (PARTITION BY {part} ORDER BY {col}) "
            f"+ (count(*) OVER (PARTITION BY {part}, {col}) - 1) / 2.0) / count({col}) OVER (PARTITION BY {part}), 6) END")


@register(
    "g_percent_rank", "G2",
    sql=with_wk(f"SELECT id, {_pct_sql('age', 'group_id')} AS age_pct, {_pct_sql('a2', 'home')} AS a2_pct FROM wk"),
)
def g_percent_rank(spark, sf_dir):
    """Percentile rank with average ties (null -> 0.5): age inside the group, a2 inside home."""
    w = keyed(wide(spark, sf_dir))
    out = FE.percent_rank_avg(w, ["group_id"], "age", "age_pct")
    out = FE.percent_rank_avg(out, ["home"], "a2", "a2_pct")
    return rounded(out.select("id", "age_pct", "a2_pct"))


@register(
    "g_occupancy", "G3",
    sql=with_wk("""
    SELECT id, CAST(count(*) OVER (PARTITION BY coalesce(deck, 'Unknown') || '_' || coalesce(side, 'Unknown')) AS BIGINT)
             AS deck_side_occupancy,
           CAST(CASE WHEN code IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY code) END AS BIGINT) AS code_occupancy
    FROM wk"""),
)
def g_occupancy(spark, sf_dir):
    """Rows per deck/side key; rows per known code, 0 when the code is unknown."""
    w = keyed(wide(spark, sf_dir)).withColumn("deck_side", C.interaction_key("deck", "side"))
    out = FE.group_transform(w, ["deck_side"], {"deck_side_occupancy": F.count(F.lit(1))})
    out = FE.group_transform(out, ["code"], {"code_occupancy": F.count(F.lit(1))})  # null code matches nothing
    return out.select("id", "deck_side_occupancy", F.coalesce("code_occupancy", F.lit(0)).cast("bigint").alias("code_occupancy"))


@register(
    "g_median_gap", "G4",
    sql=with_wk("""
    WITH m AS (SELECT deck, median(num) AS med FROM wk WHERE deck IS NOT NULL GROUP BY deck)
    SELECT id, round(num - med, 6) AS num_gap FROM wk LEFT JOIN m ON wk.deck = m.deck"""),
)
def g_median_gap(spark, sf_dir):
    """Number minus the exact median of its deck (aggregate + join; window medians are costly)."""
    w = keyed(wide(spark, sf_dir))
    return rounded(FE.group_median_gap(w, ["deck"], "num", "num_gap").select("id", "num_gap"))


@register(
    "g_mean_gap", "G5",
    sql=with_wk("""
    SELECT id, round(total - """ + _emean("total", "group_id") + """, 6) AS group_spend_gap,
           round(age - avg(age) OVER (PARTITION BY group_id), 6) AS group_age_gap,
           round(total - """ + _emean("total", "coalesce(home, 'Unknown') || '_' || coalesce(dest, 'Unknown')") + """, 6)
             AS home_dest_spend_gap
    FROM wk"""),
)
def g_mean_gap(spark, sf_dir):
    """Gaps to the group mean (spend, age) and to the home/destination mean spend."""
    w = keyed(wide(spark, sf_dir)).withColumn("home_dest", C.interaction_key("home", "dest"))
    out = FE.group_transform(w, ["group_id"], {"__ms": C.exact_mean("total"), "__ma": F.avg("age")})
    out = FE.group_transform(out, ["home_dest"], {"__mh": C.exact_mean("total")})
    return rounded(out.select(
        "id", (F.col("total") - F.col("__ms")).alias("group_spend_gap"), (F.col("age") - F.col("__ma")).alias("group_age_gap"),
        (F.col("total") - F.col("__mh")).alias("home_dest_spend_gap"),
    ))


@register(
    "g_surname_group_size", "G7",
    sql=with_wk("""SELECT id, CAST(count(*) OVER (PARTITION BY group_id, coalesce(surname, 'Unknown'))
                   AS BIGINT) AS group_surname_size FROM wk"""),
)
def g_surname_group_size(spark, sf_dir):
    """Rows sharing group and surname (a null surname is the level Unknown)."""
    w = keyed(wide(spark, sf_dir)).withColumn("surname", F.coalesce("surname", F.lit("Unknown")))
    out = FE.group_transform(w, ["group_id", "surname"], {"group_surname_size": F.count(F.lit(1))})
    return out.select("id", "group_surname_size")


@register(
    "g_union_aggregates", "G8",
    sql=with_wk(f"""
    WITH u AS (SELECT *, CASE WHEN split = 'test' THEN 'test' WHEN {sql_hash_bucket(5, 'id')} = 0 THEN 'valid' ELSE 'train' END
               AS origin FROM wk)
    SELECT id, origin, round(avg(age) OVER g, 6) AS g_age_mean, round(max(total) OVER g, 6) AS g_spend_max,
           round(CAST(sum(CAST(total AS DECIMAL(38,4))) OVER g AS DOUBLE) / count(total) OVER g, 6) AS g_spend_mean,
           CAST(max(CAST(coalesce(flag = 'True', false) AS INTEGER)) OVER g AS INTEGER) AS g_has_flag,
           CAST(count(*) OVER g AS BIGINT) AS g_size
    FROM u WINDOW g AS (PARTITION BY group_id)"""),
)
def g_union_aggregates(spark, sf_dir):
    """Group aggregates over train, validation and test parts unioned with an origin tag."""
    w = keyed(wide(spark, sf_dir))
    tr = w.filter(F.col("split") == "train").withColumn(
        "origin", F.when(C.hash_bucket(5, "id") == 0, "valid").otherwise("train"))
    te = w.filter(F.col("split") == "test").withColumn("origin", F.lit("test"))
    u = tr.unionByName(te)
    out = FE.group_transform(u, ["group_id"], {
        "g_age_mean": F.avg("age"), "g_spend_max": F.max("total"), "g_spend_mean": C.exact_mean("total"),
        "g_has_flag": F.max(F.coalesce(F.col("flag") == "True", F.lit(False)).cast("int")),
        "g_size": F.count(F.lit(1)),
    })
    return rounded(out.select("id", "origin", "g_age_mean", "g_spend_max", "g_spend_mean", "g_has_flag", "g_size"))


@register(
    "g_group_counts", "G9",
    sql=with_wk("""
    WITH c AS (SELECT group_id, surname, count(*) AS n FROM wk WHERE surname IS NOT NULL GROUP BY group_id, surname),
    mode AS (SELECT group_id, arg_min(surname, {'a': -n, 'b': surname}) AS of_group FROM c GROUP BY group_id),
    f AS (SELECT id, wk.group_id, coalesce(surname, of_group, 'Unknown') AS surname FROM wk LEFT JOIN mode ON wk.group_id = mode.group_id)
    SELECT id, CAST(count(*) OVER (PARTITION BY group_id) AS BIGINT) AS group_size, surname,
           CAST(count(*) OVER (PARTITION BY surname) AS BIGINT) AS surname_size,
           CAST(count(*) OVER (PARTITION BY group_id) = 1 AS INTEGER) AS is_solo
    FROM f"""),
)
def g_group_counts(spark, sf_dir):
    """Group size, surname size and the solo flag over the union; a missing surname is the group's mode, else Unknown, which is a level."""
    w = keyed(wide(spark, sf_dir)).select("id", "group_id", "surname")
    out = lookup(w, IM.mode_table(w, ["group_id"], "surname", "of_group"), ["group_id"])
    out = out.withColumn("surname", F.coalesce("surname", "of_group", F.lit("Unknown")))
    out = FE.group_transform(out, ["group_id"], {"group_size": F.count(F.lit(1))}, null_safe=True)
    out = FE.group_transform(out, ["surname"], {"surname_size": F.count(F.lit(1))})
    return out.select("id", "group_size", "surname", "surname_size", (F.col("group_size") == 1).cast("int").alias("is_solo"))


@register(
    "g_structure_flags", "G10",
    sql=with_wk("""
    WITH s AS (SELECT *, count(*) OVER (PARTITION BY group_id) AS gs FROM wk)
    SELECT id, CAST(gs = 1 AS INTEGER) AS is_solo, CAST(gs > 1 AS INTEGER) AS is_multi, CAST(member = 1 AS INTEGER) AS is_leader,
           round(coalesce(member / gs, 0.0), 6) AS member_ratio, CAST(member = 1 AS INTEGER) AS is_first,
           CAST(member = gs AS INTEGER) AS is_last
    FROM s"""),
)
def g_structure_flags(spark, sf_dir):
    """Solo / multi / leader flags, member ratio, first and last member."""
    w = keyed(wide(spark, sf_dir))
    out = FE.group_transform(w, ["group_id"], {"group_size": F.count(F.lit(1))})
    out = FE.structure_flags(out, "group_size", "member")
    return rounded(out.select("id", "is_solo", "is_multi", "is_leader", "member_ratio", "is_first", "is_last"))


@register(
    "g_rank01", "G11",
    sql="""SELECT id, family, split, round(CASE WHEN count(*) OVER w <= 1 THEN 0.0
           ELSE (row_number() OVER (w ORDER BY p, id) - 1) / (count(*) OVER w - 1) END, 6) AS rank01
           FROM p WINDOW w AS (PARTITION BY family, split)""",
    fixtures=("p",),
)
def g_rank01(spark, sf_dir):
    """Stable rank of the score scaled to [0, 1] inside each (family, split)."""
    p = predictions(spark, sf_dir)
    return rounded(FE.rank01(p, "p", "id", by=["family", "split"]).select("id", "family", "split", "rank01"))
