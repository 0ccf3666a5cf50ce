"""Queries of SURVEY §2.E (joins and lookups) and §2.I (set operations).

Statistics tables are joined with :func:`core.lookup`: broadcast only under
a proven bound, otherwise AQE picks broadcast or a (skew-split) sort-merge
join at run time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import impute as IM
from tessera.operators.core import lookup
from tessera.plans.registry import register
from tessera.plans.sqlparts import keyed, sql_hash_bucket, with_wk
from tessera.plans.util import rounded
from tessera.sources.fixtures import FAMILIES, predictions, wide


def TRAIN():
    return F.col("split") == "train"


FAMS = [f"f{i}" for i in FAMILIES]


@register(
    "e_left_lookup", "E1",
    sql=with_wk("""
    WITH sf AS (SELECT surname, count(*) AS n FROM wk WHERE split = 'train' AND surname IS NOT NULL GROUP BY surname),
    gs AS (SELECT group_id, count(*) AS n FROM wk GROUP BY group_id)
    SELECT id, CAST(coalesce(sf.n, 0) AS BIGINT) AS surname_freq, CAST(coalesce(gs.n, 1) AS BIGINT) AS group_size
    FROM wk LEFT JOIN sf ON wk.surname = sf.surname LEFT JOIN gs ON wk.group_id = gs.group_id"""),
)
def e_left_lookup(spark, sf_dir):
    """Key -> statistic lookups with defaults (unseen surname 0, unseen group 1)."""
    w = keyed(wide(spark, sf_dir))
    sf = w.filter(TRAIN() & F.col("surname").isNotNull()).groupBy("surname").agg(F.count(F.lit(1)).alias("surname_freq"))
    gs = w.groupBy("group_id").agg(F.count(F.lit(1)).alias("group_size"))
    out = lookup(lookup(w, sf, ["surname"]), gs, ["group_id"])
    return out.select(
        "id", F.coalesce("surname_freq", F.lit(0)).cast("bigint").alias("surname_freq"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
    )


@register(
    "e_nullsafe_join", "E2",
    sql="""
    WITH st AS (SELECT home, vip, avg(age) AS level_age, count(*) AS level_n FROM w WHERE split = 'train' GROUP BY home, vip)
    SELECT id, w.home, w.vip, round(level_age, 6) AS level_age, CAST(level_n AS BIGINT) AS level_n
    FROM w LEFT JOIN st ON w.home IS NOT DISTINCT FROM st.home AND w.vip IS NOT DISTINCT FROM st.vip""",
)
def e_nullsafe_join(spark, sf_dir):
    """Multi-column lookup where a null key value is a level of its own."""
    w = wide(spark, sf_dir)
    st = w.filter(TRAIN()).groupBy("home", "vip").agg(F.avg("age").alias("level_age"), F.count(F.lit(1)).alias("level_n"))
    return rounded(lookup(w, st, ["home", "vip"], null_safe=True).select("id", "home", "vip", "level_age", "level_n"))


@register(
    "e_merge_coalesce", "E3",
    sql="""
    WITH b AS (SELECT id, substr(id, 1, 4) AS room, code FROM w),
    g AS (SELECT room, arg_min(code, id) AS code_y FROM b WHERE code IS NOT NULL GROUP BY room)
    SELECT id, coalesce(code, code_y) AS code FROM b LEFT JOIN g USING (room)""",
)
def e_merge_coalesce(spark, sf_dir):
    """Left merge on the room key with the guide's value, coalesce, drop the helper."""
    b = wide(spark, sf_dir).select("id", F.substring("id", 1, 4).alias("room"), "code")
    return IM.first_seen_fill(b, "room", "code", "id").select("id", "code")


@register(
    "e_family_join", "E4",
    sql="SELECT id, " + ", ".join(f"round(max(CASE WHEN family = '{f}' THEN p END), 6) AS {f}" for f in FAMS)
        + " FROM p GROUP BY id",
    fixtures=("p",),
)
def e_family_join(spark, sf_dir):
    """Model families side by side on id: long table pivoted with the family list given (one shuffle)."""
    p = predictions(spark, sf_dir)
    return rounded(p.groupBy("id").pivot("family", FAMS).agg(F.max("p")))


@register(
    "e_semi_join", "E6",
    sql="SELECT id, y, split FROM w WHERE id IN (SELECT id FROM p WHERE family = 'f1' AND (p >= 0.98 OR p <= 0.02))",
    fixtures=("p",),
)
def e_semi_join(spark, sf_dir):
    """Rows whose id is among the confident predictions (left semi join)."""
    w = wide(spark, sf_dir)
    conf = predictions(spark, sf_dir, w).filter((F.col("family") == "f1") & ((F.col("p") >= 0.98) | (F.col("p") <= 0.02)))
    return w.join(conf.select("id"), "id", "left_semi").select("id", "y", "split")


@register(
    "e_overlap_check", "E7/I5",
    sql=with_wk("""
    SELECT 'id_overlap' AS check_name, CAST(count(*) AS BIGINT) AS n FROM
      (SELECT id FROM wk WHERE split = 'train' INTERSECT SELECT id FROM wk WHERE split = 'test') a
    UNION ALL
    SELECT 'group_overlap', CAST(count(*) AS BIGINT) FROM
      (SELECT group_id FROM wk WHERE split = 'train' INTERSECT SELECT group_id FROM wk WHERE split = 'test') b
    UNION ALL
    SELECT 'surname_overlap', CAST(count(*) AS BIGINT) FROM
      (SELECT surname FROM wk WHERE split = 'train' INTERSECT SELECT surname FROM wk WHERE split = 'test') c
    UNION ALL
    SELECT 'test_surname_unseen', CAST(count(*) AS BIGINT) FROM
      (SELECT id FROM wk t WHERE split = 'test' AND NOT EXISTS
         (SELECT 1 FROM wk r WHERE r.split = 'train' AND r.surname = t.surname)) d"""),
)
def e_overlap_check(spark, sf_dir):
    """Overlaps between splits (intersect) and rows missing in the other split (anti join)."""
    w = keyed(wide(spark, sf_dir))
    tr, te = w.filter(TRAIN()), w.filter(F.col("split") == "test")

    def overlap(col, name):
        return tr.select(col).intersect(te.select(col)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_name"), "n")

    unseen = te.join(tr.select("surname"), "surname", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return (
        overlap("id", "id_overlap").unionByName(overlap("group_id", "group_overlap"))
        .unionByName(overlap("surname", "surname_overlap"))
        .unionByName(unseen.select(F.lit("test_surname_unseen").alias("check_name"), "n"))
    )


@register(
    "e_concat_columns", "E10",
    sql="SELECT id, round(ln(1 + greatest(a1, 0.0)), 6) AS a1_log, round(ln(1 + greatest(a2, 0.0)), 6) AS a2_log, "
        "CAST(home = 'ASIA' AS INTEGER) AS home_ASIA, CAST(home = 'EUROPE' AS INTEGER) AS home_EUROPE FROM w",
)
def e_concat_columns(spark, sf_dir):
    """Encoded columns appended to the same rows in one projection (no positional concat)."""
    w = wide(spark, sf_dir)
    return rounded(w.select(
        "id", C.log1p_clipped("a1").alias("a1_log"), C.log1p_clipped("a2").alias("a2_log"),
        (F.col("home") == "ASIA").cast("int").alias("home_ASIA"), (F.col("home") == "EUROPE").cast("int").alias("home_EUROPE"),
    ))


# ------------------------------------------------------------------ 2.I


@register(
    "i_union_splits", "I1",
    sql=f"""
    WITH u AS (
      SELECT id, y, CASE WHEN {sql_hash_bucket(5, 'id')} = 0 THEN 'valid' ELSE 'train' END AS origin FROM w WHERE split = 'train'
      UNION ALL SELECT id, NULL AS y, 'test' AS origin FROM w WHERE split = 'test')
    SELECT origin, CAST(count(*) AS BIGINT) AS n, CAST(count(y) AS BIGINT) AS labelled FROM u GROUP BY origin""",
)
def i_union_splits(spark, sf_dir):
    """Train, validation and test parts unioned by name with an origin tag, then split back."""
    w = wide(spark, sf_dir)
    tr = w.filter(TRAIN()).select("id", "y", F.when(C.hash_bucket(5, "id") == 0, "valid").otherwise("train").alias("origin"))
    te = w.filter(F.col("split") == "test").select("id", F.lit("test").alias("origin"))
    u = tr.unionByName(te, allowMissingColumns=True)
    return u.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("labelled"))


@register(
    "i_pseudo_append", "I2/L16",
    sql="""
    WITH conf AS (SELECT id, CAST(p >= 0.98 AS INTEGER) AS y FROM p WHERE family = 'f1' AND split = 'test' AND (p >= 0.98 OR p <= 0.02)),
    ok AS (SELECT count(*) >= 100 AS enough FROM conf)
    SELECT id, y, 'train' AS origin FROM w WHERE split = 'train'
    UNION ALL SELECT id, y, 'pseudo' AS origin FROM conf WHERE (SELECT enough FROM ok)""",
    fixtures=("p",),
)
def i_pseudo_append(spark, sf_dir):
    """Confident test rows (p >= .98 or <= .02) appended with their predicted label; none if < 100."""
    from tessera.operators.models import pseudo_label_rows

    w = wide(spark, sf_dir)
    p = predictions(spark, sf_dir, w).filter((F.col("family") == "f1") & (F.col("split") == "test"))
    pseudo = pseudo_label_rows(p, "p", "y", hi=0.98, lo=0.02, min_rows=100)
    train = w.filter(TRAIN()).select("id", "y", F.lit("train").alias("origin"))
    return train.unionByName(pseudo.select("id", "y", F.lit("pseudo").alias("origin")))


@register(
    "i_level_union", "I6",
    sql="""
    WITH lv AS (SELECT 'home' AS column_name, home AS level FROM w WHERE split = 'train' AND home IS NOT NULL
                UNION SELECT 'home', home FROM w WHERE split = 'test' AND home IS NOT NULL
                UNION SELECT 'dest', dest FROM w WHERE split = 'train' AND dest IS NOT NULL
                UNION SELECT 'dest', dest FROM w WHERE split = 'test' AND dest IS NOT NULL)
    SELECT column_name, level, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY level) - 1 AS INTEGER) AS idx FROM lv""",
)
def i_level_union(spark, sf_dir):
    """Category levels = union of the levels of every split, indexed alphabetically."""
    from tessera.operators.encode import level_index

    w = wide(spark, sf_dir)
    return level_index(w, ["home", "dest"])


@register(
    "i_distinct_key", "I7",
    sql="SELECT substr(id, 1, 4) AS room, min(id) AS first_id, (list(home ORDER BY id))[1] AS home FROM w GROUP BY substr(id, 1, 4)",
)
def i_distinct_key(spark, sf_dir):
    """First row per key (``drop_duplicates`` with an explicit order) as a min_by aggregate."""
    w = wide(spark, sf_dir).withColumn("room", F.substring("id", 1, 4))
    return w.groupBy("room").agg(F.min("id").alias("first_id"), F.min_by("home", "id").alias("home"))
