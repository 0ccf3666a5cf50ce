"""Queries of SURVEY §2.H (sorts, limits, top-k).

Top-k per group is ``row_number() <= k`` over a window: Spark 4 inserts a
partial per-partition limit before the shuffle (WindowGroupLimit), so a hot
group sends at most k rows per map task.  A global top-n is a take-ordered
limit.  The limits here are the feature (top-k reports), not row caps.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators.core import attach_row, ordered_index
from tessera.operators.blend import top_rate_cuts
from tessera.plans.registry import register
from tessera.plans.util import rounded
from tessera.sources.fixtures import EVENT_TYPES, FAMILIES, predictions
from tessera.sources.tables import table

FAMS = [f"f{i}" for i in FAMILIES]
_ORDER_LIST = "[" + ", ".join(f"'{t}'" for t in EVENT_TYPES) + "]"

_IMPORTANCE_SQL = f"""
imp AS (SELECT event_type AS feature, CAST(sum(CAST(value AS DECIMAL(38,4))) AS DOUBLE) / count(value) AS mean,
               CAST(sum(CAST(value AS DECIMAL(38,4))) AS DOUBLE) AS total,
               list_position({_ORDER_LIST}, event_type) AS orig
        FROM events GROUP BY event_type),
ranked AS (SELECT *, row_number() OVER (ORDER BY mean DESC, total DESC, orig) AS rk FROM imp)"""


def _importance(spark, sf_dir):
    """Per-feature importance-like table: mean, sum and the original feature order."""
    ev = table(spark, sf_dir, "events", "event_type", "value")
    order = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col("event_type"))
    imp = ev.groupBy("event_type").agg(
        C.exact_mean("value").alias("mean"), C.exact_sum("value").cast("double").alias("total")
    ).select(F.col("event_type").alias("feature"), "mean", "total", order.cast("bigint").alias("orig"))
    return ordered_index(imp, [F.desc("mean"), F.desc("total"), F.asc("orig")], name="rk")


@register(
    "h_sort_ties", "H1",
    sql="WITH " + _IMPORTANCE_SQL + " SELECT feature, round(mean, 6) AS mean, round(total, 6) AS total, orig, rk FROM ranked",
    fixtures=(),
)
def h_sort_ties(spark, sf_dir):
    """H1: sort by mean desc, sum desc, original order asc; rank as a column (range-partitioned)."""
    return rounded(_importance(spark, sf_dir))


@register(
    "h_topk_features", "H2",
    sql="WITH " + _IMPORTANCE_SQL + """,
    k AS (SELECT least(greatest(count(*) FILTER (WHERE mean <> 0), 2), 4) AS k FROM imp)
    SELECT feature, rk FROM ranked, k WHERE rk <= k.k""",
    fixtures=(),
)
def h_topk_features(spark, sf_dir):
    """H2: keep k = (non-zero count clipped to [2, 4]) best features."""
    r = _importance(spark, sf_dir)
    k = r.agg(F.least(F.greatest(F.count(F.when(F.col("mean") != 0, 1)), F.lit(2)), F.lit(4)).alias("__k"))
    return attach_row(r, k).filter(F.col("rk") <= F.col("__k")).select("feature", "rk")


@register(
    "h_topk_per_band", "H3",
    sql="""
    WITH band AS (SELECT id, family, p, 1 AS priority,
                         row_number() OVER (PARTITION BY family ORDER BY p DESC, id) AS rk FROM p),
    overall AS (SELECT id, family, p, 2 AS priority, row_number() OVER (ORDER BY p DESC, id, family) AS rk FROM p),
    u AS (SELECT * FROM band WHERE rk <= 3 UNION ALL SELECT * FROM overall WHERE rk <= 5),
    d AS (SELECT *, row_number() OVER (PARTITION BY id, family ORDER BY priority, rk) AS dup FROM u)
    SELECT id, family, round(p, 6) AS p, priority, rk FROM d WHERE dup = 1
    ORDER BY priority, rk, family, id LIMIT 14""",
    fixtures=("p",),
)
def h_topk_per_band(spark, sf_dir):
    """H3: 3 best per band (family) first, then the overall best, de-duplicated by priority, head 14."""
    p = predictions(spark, sf_dir)
    w_band = Window.partitionBy("family").orderBy(F.desc("p"), "id")
    band = p.withColumn("rk", F.row_number().over(w_band)).filter(F.col("rk") <= 3).withColumn("priority", F.lit(1))
    overall = p.orderBy(F.desc("p"), "id", "family").limit(5)
    overall = overall.withColumn("rk", F.row_number().over(Window.orderBy(F.desc("p"), "id", "family")))  # 5 rows
    u = band.select("id", "family", "p", "priority", "rk").unionByName(
        overall.select("id", "family", "p", F.lit(2).alias("priority"), "rk"))
    d = u.groupBy("id", "family").agg(F.min_by(F.struct("priority", "rk", "p"), F.struct("priority", "rk")).alias("b"))
    out = d.select("id", "family", "b.p", "b.priority", "b.rk").orderBy("priority", "rk", "family", "id").limit(14)
    return rounded(out.select("id", "family", "p", F.col("priority").cast("int"), F.col("rk").cast("bigint")))


@register(
    "h_topn_confidence", "H4",
    sql="""
    WITH wide AS (SELECT id, max(CASE WHEN family = 'f2' THEN p END) AS f2, max(CASE WHEN family = 'f3' THEN p END) AS f3
                  FROM p GROUP BY id)
    SELECT id, CAST(f3 >= 0.5 AS INTEGER) AS base_label, CAST(f2 >= 0.5 AS INTEGER) AS new_label,
           round(abs(f2 - 0.5), 6) AS margin
    FROM wide WHERE (f2 >= 0.5) <> (f3 >= 0.5) ORDER BY abs(f2 - 0.5) DESC, id LIMIT 50""",
    fixtures=("p",),
)
def h_topn_confidence(spark, sf_dir):
    """Among rows where two families disagree, the 50 where the override family is most confident."""
    p = predictions(spark, sf_dir).filter(F.col("family").isin("f2", "f3"))
    wide = p.groupBy("id").pivot("family", ["f2", "f3"]).agg(F.max("p"))
    dis = wide.filter((F.col("f2") >= 0.5) != (F.col("f3") >= 0.5))
    top = dis.orderBy(F.desc(F.abs(F.col("f2") - 0.5)), "id").limit(50)
    return rounded(top.select(
        "id", (F.col("f3") >= 0.5).cast("int").alias("base_label"), (F.col("f2") >= 0.5).cast("int").alias("new_label"),
        F.abs(F.col("f2") - 0.5).alias("margin"),
    ))


@register(
    "h_top_rate_cut", "H5",
    sql="""
    WITH r AS (SELECT family, id, p, row_number() OVER (PARTITION BY family ORDER BY p DESC, id) AS rn,
                      count(*) OVER (PARTITION BY family) AS n FROM p),
    rates AS (SELECT * FROM (VALUES ('none', 0.0::DOUBLE), ('some', 0.35::DOUBLE), ('all', 1.0::DOUBLE)) v(candidate, rate)),
    k AS (SELECT family, n, candidate, CAST(round_even(n * rate, 0) AS BIGINT) AS k FROM (SELECT DISTINCT family, n FROM r), rates),
    t AS (SELECT k.family, k.candidate, k.k, CASE WHEN k.k > 0 AND k.k < k.n
                 THEN (max(CASE WHEN rn = k.k THEN p END) + max(CASE WHEN rn = k.k + 1 THEN p END)) / 2 ELSE 0.5 END AS threshold
          FROM r JOIN k ON r.family = k.family GROUP BY k.family, k.candidate, k.k, k.n)
    SELECT r.family, r.id, t.candidate, r.rn <= t.k AS label, round(t.threshold, 6) AS threshold FROM r JOIN t ON r.family = t.family""",
    fixtures=("p",),
)
def h_top_rate_cut(spark, sf_dir):
    """H5: the round(rate n) highest scores are positive (ties by id), for rates 0, 0.35 and 1; labels and midpoint threshold."""
    r, cuts = top_rate_cuts(predictions(spark, sf_dir), {"none": 0.0, "some": 0.35, "all": 1.0}, ["family"])
    out = r.join(F.broadcast(cuts.select("family", "candidate", "k", "threshold")), "family")  # families x rates rows
    return rounded(out.select("family", "id", "candidate", (F.col("rn") <= F.col("k")).alias("label"), "threshold"))
