"""Queries of SURVEY §2.F (aggregations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import profile as PR
from tessera.operators.core import lookup
from tessera.operators.features import amount_features
from tessera.plans.registry import register
from tessera.plans.sqlparts import keyed, with_wk
from tessera.plans.util import rounded
from tessera.sources.fixtures import AMOUNTS, EVENT_TYPES, events_pivot, predictions, wide

A = AMOUNTS

def TRAIN():
    return F.col("split") == "train"


LUX, BASIC = ["a4", "a5"], ["a1", "a2", "a3"]


def _count_lookup(df, keys, name, fit_on=None, default=None):
    src = df.filter(fit_on) if fit_on is not None else df
    st = src.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    out = lookup(df, st, keys)
    if default is not None:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)).cast("bigint"))
    return out


@register(
    "f_group_size_combined", "F1",
    sql=with_wk("SELECT id, CAST(count(*) OVER (PARTITION BY group_id) AS BIGINT) AS group_size FROM wk"),
)
def f_group_size_combined(spark, sf_dir):
    """rows per group over train and test together (aggregate + join, not a window)."""
    return _count_lookup(keyed(wide(spark, sf_dir)), ["group_id"], "group_size").select("id", "group_size")


@register(
    "f_group_size_split", "F2",
    sql=with_wk("SELECT id, split, CAST(count(*) OVER (PARTITION BY split, group_id) AS BIGINT) AS group_size FROM wk"),
)
def f_group_size_split(spark, sf_dir):
    """The same inside each split."""
    return _count_lookup(keyed(wide(spark, sf_dir)), ["split", "group_id"], "group_size").select("id", "split", "group_size")


@register(
    "f_group_size_trainfit", "F3",
    sql="""
    WITH c AS (SELECT code, count(*) AS n FROM w WHERE split = 'train' GROUP BY code)
    SELECT id, CAST(coalesce(c.n, 1) AS BIGINT) AS code_size FROM w LEFT JOIN c ON w.code = c.code""",
)
def f_group_size_trainfit(spark, sf_dir):
    """counts from the train rows only; unseen (or null) key -> 1."""
    return _count_lookup(wide(spark, sf_dir), ["code"], "code_size", fit_on=TRAIN(), default=1).select("id", "code_size")


@register(
    "f_value_freq", "F4",
    sql=with_wk("""
    WITH c AS (SELECT surname, count(*) AS n FROM wk WHERE split = 'train' AND surname IS NOT NULL GROUP BY surname)
    SELECT id, CAST(coalesce(c.n, 0) AS BIGINT) AS surname_freq FROM wk LEFT JOIN c ON wk.surname = c.surname"""),
)
def f_value_freq(spark, sf_dir):
    """train frequency of the non-null surname; unseen -> 0 (counted before any 'Unknown' fill)."""
    w = keyed(wide(spark, sf_dir))
    return _count_lookup(w, ["surname"], "surname_freq", fit_on=TRAIN() & F.col("surname").isNotNull(), default=0).select(
        "id", "surname_freq"
    )


@register(
    "f_quantiles", "F5",
    sql="""SELECT home, round(q[1], 6) AS q25, round(q[2], 6) AS q50, round(q[3], 6) AS q75, round(med_age, 6) AS med_age
    FROM (SELECT home, quantile_cont(a2, [0.25, 0.5, 0.75]) AS q, median(age) AS med_age FROM w GROUP BY home) t""",
)
def f_quantiles(spark, sf_dir):
    """exact linear-interpolation quantiles and medians per key."""
    w = wide(spark, sf_dir)
    q = PR.quantiles(w, "a2", [0.25, 0.5, 0.75], by=["home"])
    m = PR.quantiles(w, "age", [0.5], by=["home"]).withColumnRenamed("q50", "med_age")
    return rounded(lookup(q, m, ["home"], null_safe=True))


@register(
    "f_lower_quantile", "F6",
    sql="""
    WITH r AS (SELECT family, p, row_number() OVER (PARTITION BY family ORDER BY p, id) AS rn,
                      count(*) OVER (PARTITION BY family) AS n FROM p)
    SELECT family, q, round(p, 6) AS value FROM r, (VALUES (0.3), (0.67)) qs(q) WHERE rn = floor(q * (n - 1)) + 1""",
    fixtures=("p",),
)
def f_lower_quantile(spark, sf_dir):
    """Order statistic floor(q (n-1)) per family (numpy "lower"), q = 0.3 and 0.67."""
    p = predictions(spark, sf_dir)
    a = PR.lower_quantile(p, "p", 0.3, by=["family"], tie="id")
    b = PR.lower_quantile(p, "p", 0.67, by=["family"], tie="id")
    return rounded(a.unionByName(b).select("family", F.col("q").cast("decimal(3,2)").cast("double").alias("q"), "value"))


_CATS = ["home", "dest", "vip", "flag", "code", "name"]


@register(
    "f_distinct_counts", "F7",
    sql=" UNION ALL ".join(
        f"SELECT {scope} AS scope, '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM w {grp}"
        for c in _CATS
        for scope, grp in (("split", "GROUP BY split"), ("'all'", ""))
    ),
)
def f_distinct_counts(spark, sf_dir):
    """distinct values per column, per split and combined (one aggregate each)."""
    w = wide(spark, sf_dir)
    per = PR.distinct_counts(w, _CATS, by="split").withColumnRenamed("split", "scope")
    allr = PR.distinct_counts(w, _CATS).select(F.lit("all").alias("scope"), "column_name", "n_distinct")
    return per.unionByName(allr)


_ALL = ["home", "dest", "vip", "flag", "code", "age", *A, "name", "y"]


@register(
    "f_null_counts", "F8",
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
        f"round((count(*) - count({c})) / count(*), 6) AS rate FROM w" for c in _ALL
    ),
)
def f_null_counts(spark, sf_dir):
    """F8: null count and rate of every column in one aggregate, unpivoted."""
    return rounded(PR.null_counts(wide(spark, sf_dir), _ALL))


_SUMMARY_COLS = ["id", "member_no", *_ALL, "split"]


@register(
    "f_schema_summary", "F9/I4",
    sql="WITH t AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, " + ", ".join(
            f"CAST(count(*) FILTER (split = '{s}' AND {c} IS NULL) AS BIGINT) AS {s}_missing, "
            f"CAST(count(DISTINCT {c}) FILTER (split = '{s}') AS BIGINT) AS {s}_unique" for s in ("train", "test")) + " FROM w"
        for c in _SUMMARY_COLS) + """)
    SELECT column_name, column_name <> 'y' AS shared, column_name = 'y' AS train_only, train_missing, train_unique,
           CASE WHEN column_name <> 'y' THEN test_missing END AS test_missing, CASE WHEN column_name <> 'y' THEN test_unique END AS test_unique FROM t""",
)
def f_schema_summary(spark, sf_dir):
    """Columns of the labelled and unlabelled parts with missing and distinct counts (train has the label, test not)."""
    w = wide(spark, sf_dir)
    t = PR.schema_summary(w.filter(TRAIN()), w.filter(F.col("split") == "test").drop("y"))
    return t.select("column_name", "shared", "train_only", "train_missing", "train_unique", "test_missing", "test_unique")


def _amount_sql(names):
    total = " + ".join(f"coalesce({a}, 0.0)" for a in A)
    lux = " + ".join(f"coalesce({a}, 0.0)" for a in LUX)
    npos = " + ".join(f"coalesce(CAST({a} > 0 AS INTEGER), 0)" for a in A)
    mean = f"(({total}) / 5.0)"
    exprs = {
        "total": total,
        "total_cc": " + ".join(A),
        "luxury": lux,
        "basic": " + ".join(f"coalesce({a}, 0.0)" for a in BASIC),
        "active_count": npos,
        "amount_std": "sqrt((" + " + ".join(f"(coalesce({a}, 0.0) - {mean}) * (coalesce({a}, 0.0) - {mean})" for a in A) + ") / 5.0)",
        "amount_max": f"greatest({', '.join(A)})",
        "nonzero_share": f"({npos}) / 5.0",
        "luxury_share": f"coalesce(({lux}) / (({total}) + 1.0), 0.0)",
        "per_active": f"coalesce(({total}) / nullif({npos}, 0), 0.0)",
        "has_luxury": f"CAST(({lux}) > 0 AS INTEGER)",
    }
    ints = {"active_count", "has_luxury"}
    return "SELECT id, " + ", ".join(
        f"{exprs[n]} AS {n}" if n in ints else f"round({exprs[n]}, 6) AS {n}" for n in names
    ) + " FROM w"


_F10 = ["total", "total_cc", "luxury", "basic", "active_count"]
_F11 = ["amount_std", "amount_max", "nonzero_share"]
_F12 = ["luxury_share", "per_active", "has_luxury"]


@register("f_row_sums", "F10", sql=_amount_sql(_F10))
def f_row_sums(spark, sf_dir):
    """skip-null and complete-case row sums, group sums, active count."""
    return rounded(amount_features(wide(spark, sf_dir), A, LUX, BASIC).select("id", *_F10))


@register("f_row_std_max", "F11", sql=_amount_sql(_F11))
def f_row_std_max(spark, sf_dir):
    """population std, max and non-zero share across the five amounts."""
    return rounded(amount_features(wide(spark, sf_dir), A, LUX, BASIC).select("id", *_F11))


@register("f_row_shares", "F12", sql=_amount_sql(_F12))
def f_row_shares(spark, sf_dir):
    """luxury share, per-active spend (0 if none), any-luxury flag."""
    return rounded(amount_features(wide(spark, sf_dir), A, LUX, BASIC).select("id", *_F12))


@register(
    "f_mean_std_sum", "F13",
    sql="""SELECT event_type AS feature, round(avg(value), 6) AS mean, round(coalesce(stddev_samp(value), 0.0), 6) AS std,
           round(sum(value), 6) AS total, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type""",
    fixtures=(),
)
def f_mean_std_sum(spark, sf_dir):
    """mean, sample std (null -> 0) and sum per key."""
    from tessera.sources.tables import table

    ev = table(spark, sf_dir, "events", "event_type", "value")
    return rounded(ev.groupBy(F.col("event_type").alias("feature")).agg(
        F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"),
    ))


_FLAGV = ["False", "Missing", "True"]


@register(
    "f_crosstab", "F15",
    sql="""
    WITH t AS (SELECT coalesce(home, 'Missing') AS home, """ + ", ".join(
        f"CAST(count(*) FILTER (WHERE coalesce(flag, 'Missing') = '{v}') AS BIGINT) AS n_{v}" for v in _FLAGV) + """
      FROM w GROUP BY coalesce(home, 'Missing'))
    SELECT home, """ + ", ".join(f"n_{v}" for v in _FLAGV) + ", " + ", ".join(
        f"round(n_{v} / ({' + '.join(f'n_{x}' for x in _FLAGV)}), 6) AS share_{v}" for v in _FLAGV) + " FROM t",
)
def f_crosstab(spark, sf_dir):
    """counts of home x flag (null as Missing) and row-normalised shares."""
    return rounded(PR.crosstab(wide(spark, sf_dir), "home", "flag", _FLAGV))


@register(
    "f_unpivot", "F16",
    sql="SELECT user_id, day, feature, round(value, 6) AS value FROM (" + " UNION ALL ".join(
        f"SELECT user_id, day, '{t}' AS feature, {t} AS value FROM e" for t in EVENT_TYPES) + ") t",
    fixtures=("e",),
)
def f_unpivot(spark, sf_dir):
    """F16: wide amounts melted to (id, feature, value), nulls kept."""
    e = events_pivot(spark, sf_dir)
    return rounded(e.unpivot(["user_id", "day"], EVENT_TYPES, "feature", "value"))


@register(
    "f_pivot", "F17",
    sql="SELECT user_id, day, " + ", ".join(f"round({t}, 6) AS {t}" for t in EVENT_TYPES) + " FROM e",
    fixtures=("e",),
)
def f_pivot(spark, sf_dir):
    """long (user, day, type, value) to one column per type, with the type list given."""
    return rounded(events_pivot(spark, sf_dir))


@register(
    "f_histogram", "F18",
    sql="""
    WITH l AS (SELECT 'a2' AS column_name, a2 AS x FROM w WHERE a2 IS NOT NULL
               UNION ALL SELECT 'a2_log', ln(1 + greatest(a2, 0.0)) FROM w WHERE a2 IS NOT NULL),
    r AS (SELECT column_name, min(x) AS lo, max(x) AS hi FROM l GROUP BY column_name),
    b AS (SELECT l.column_name, lo, hi, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 10)), 9) END AS INTEGER) AS bin
          FROM l JOIN r USING (column_name))
    SELECT column_name, bin, round(lo + bin * (hi - lo) / 10, 6) AS "left", round(lo + (bin + 1) * (hi - lo) / 10, 6) AS "right",
           CAST(count(*) AS BIGINT) AS n FROM b GROUP BY column_name, bin, lo, hi""",
)
def f_histogram(spark, sf_dir):
    """10 equal-width bins over the observed range, raw and log1p."""
    w = wide(spark, sf_dir).filter(F.col("a2").isNotNull())
    long = w.select(F.lit("a2").alias("column_name"), F.col("a2").alias("x")).unionByName(
        w.select(F.lit("a2_log").alias("column_name"), C.log1p_clipped("a2").alias("x"))
    )
    return rounded(PR.histogram(long, "x", 10, by=["column_name"]))


@register(
    "f_box_stats", "F19",
    sql="""
    WITH q AS (SELECT home, CAST(count(age) AS BIGINT) AS n, quantile_cont(age, [0.25, 0.5, 0.75]) AS qq FROM w GROUP BY home),
    f AS (SELECT home, n, qq[1] AS q1, qq[2] AS median, qq[3] AS q3, qq[1] - 1.5 * (qq[3] - qq[1]) AS lo_f,
                 qq[3] + 1.5 * (qq[3] - qq[1]) AS hi_f FROM q),
    wh AS (SELECT w.home, min(CASE WHEN age >= lo_f AND age <= hi_f THEN age END) AS whisker_lo,
                  max(CASE WHEN age >= lo_f AND age <= hi_f THEN age END) AS whisker_hi,
                  CAST(sum(CASE WHEN age >= lo_f AND age <= hi_f THEN 0 ELSE 1 END) AS BIGINT) AS outliers
           FROM w JOIN f ON w.home IS NOT DISTINCT FROM f.home WHERE age IS NOT NULL GROUP BY w.home)
    SELECT f.home, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(whisker_lo, 6) AS whisker_lo, round(whisker_hi, 6) AS whisker_hi, outliers
    FROM f JOIN wh ON f.home IS NOT DISTINCT FROM wh.home""",
)
def f_box_stats(spark, sf_dir):
    """Quartiles, whiskers and outlier counts of age per home."""
    w = wide(spark, sf_dir)
    return rounded(PR.box_stats(w, "age", by=["home"]))


@register(
    "f_top_other", "F20",
    sql="""
    WITH c AS (SELECT code, count(*) AS n FROM w GROUP BY code),
    r AS (SELECT *, row_number() OVER (ORDER BY n DESC, code ASC NULLS FIRST) AS rk FROM c)
    SELECT CASE WHEN rk <= 5 THEN coalesce(code, 'Missing') ELSE 'Other' END AS value, CAST(sum(n) AS BIGINT) AS n
    FROM r GROUP BY 1""",
)
def f_top_other(spark, sf_dir):
    """five most frequent codes, the rest as Other."""
    return PR.top_other(wide(spark, sf_dir), "code", 5).withColumn("n", F.col("n").cast("bigint"))


@register(
    "f_zero_share", "F21",
    sql=" UNION ALL ".join(
        f"SELECT '{a}' AS column_name, round(avg(CASE WHEN {a} IS NOT NULL THEN CAST({a} = 0 AS DOUBLE) END), 6) AS zero_share FROM w"
        for a in A
    ),
)
def f_zero_share(spark, sf_dir):
    """share of zeros among non-null values per amount column."""
    return rounded(PR.zero_share(wide(spark, sf_dir), A))


@register(
    "f_freq_of_freq", "F22",
    sql=with_wk("""
    SELECT CASE WHEN n = 1 THEN '1' WHEN n = 2 THEN '2' WHEN n <= 5 THEN '3-5' WHEN n <= 10 THEN '6-10' ELSE '>10' END AS times,
           CAST(count(*) AS BIGINT) AS "values"
    FROM (SELECT group_id, count(*) AS n FROM wk GROUP BY group_id) t GROUP BY 1"""),
)
def f_freq_of_freq(spark, sf_dir):
    """how many groups have 1, 2, 3-5, 6-10, >10 members."""
    return PR.freq_of_freq(keyed(wide(spark, sf_dir)), "group_id")


@register(
    "f_value_buckets", "F23",
    sql="""SELECT CAST(sum(CASE WHEN age BETWEEN 0 AND 100 THEN 1 ELSE 0 END) AS BIGINT) AS valid,
           CAST(sum(CASE WHEN age < 0 OR age > 100 THEN 1 ELSE 0 END) AS BIGINT) AS out_of_range,
           CAST(sum(CASE WHEN age IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
           round(avg(CAST(age IS NULL AS DOUBLE)), 6) AS missing_share FROM w""",
)
def f_value_buckets(spark, sf_dir):
    """valid / out-of-range / missing counts of age and the missing share."""
    return rounded(PR.value_buckets(wide(spark, sf_dir), "age", 0.0, 100.0))
