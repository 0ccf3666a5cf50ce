"""Queries of SURVEY §2.J (binning, scaling, encoding)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import encode as EN
from tessera.operators import features as FE
from tessera.operators import transforms as TR
from tessera.operators.core import attach_row, lookup, materialize
from tessera.operators.binning import apply_quantile_bins, count_bucket, fit_quantile_edges, fixed_bins
from tessera.plans import common_frame as CF
from tessera.plans.common_frame_sql import age_group as age_group_sql
from tessera.plans.registry import register
from tessera.plans.sqlparts import keyed, sql_hash_bucket, with_wk
from tessera.plans.util import rounded
from tessera.sources.fixtures import AMOUNTS, labelled_documents, wide
from tessera.sources.tables import table

A = AMOUNTS


def TRAIN():
    return F.col("split") == "train"


def _edges_sql(col: str, src: str, keys: str = "") -> str:
    """Twin of ``binning.quantile_edges_fit``: interior edges of up to 5 quantile bins."""
    sel = f"{keys}, " if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {sel}list_sort(list_distinct(list_filter(
           CASE WHEN nd <= 1 THEN []::DOUBLE[] WHEN nd = 2 THEN q2 WHEN nd = 3 THEN q3 WHEN nd = 4 THEN q4 ELSE q5 END,
           lambda e: e > lo AND e < hi))) AS edges
      FROM (SELECT {sel}count(DISTINCT {col}) AS nd, min({col}) AS lo, max({col}) AS hi,
                   quantile_cont({col}, [1/2]) AS q2, quantile_cont({col}, [1/3, 2/3]) AS q3,
                   quantile_cont({col}, [1/4, 2/4, 3/4]) AS q4, quantile_cont({col}, [1/5, 2/5, 3/5, 4/5]) AS q5
            FROM {src} WHERE {col} IS NOT NULL {grp}) t"""


def _bin_sql(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN 'Bin_Missing' ELSE 'Bin_' || CAST(len(list_filter(edges, lambda e: e < {col})) + 1 AS VARCHAR) END"


@register(
    "j_quantile_bins", "J1",
    sql=f"WITH e AS ({_edges_sql('a2', "(SELECT * FROM w WHERE split = 'train') tr")}) "
        f"SELECT id, {_bin_sql('a2')} AS a2_bin FROM w, e",
)
def j_quantile_bins(spark, sf_dir):
    """Up to 5 quantile bins on train values, right-closed, merged duplicate edges, null -> own bin."""
    w = wide(spark, sf_dir)
    edges = fit_quantile_edges(w, "a2", 5, fit_on=TRAIN())
    return apply_quantile_bins(attach_row(w, edges), "a2", None, "a2_bin").select("id", "a2_bin")


_FOLD5 = sql_hash_bucket(5, "id", seed=7)


@register(
    "j_fold_quantile_bins", "J2",
    sql=f"""
    WITH t AS (SELECT id, a2, {_FOLD5} AS fold FROM w WHERE split = 'train'),
    x AS (SELECT f.fit_fold, t.a2 FROM t JOIN (SELECT range AS fit_fold FROM range(5)) f ON t.fold <> f.fit_fold),
    e AS ({_edges_sql('a2', 'x', 'fit_fold')})
    SELECT id, fold, {_bin_sql('a2')} AS a2_bin FROM t JOIN e ON t.fold = e.fit_fold""",
)
def j_fold_quantile_bins(spark, sf_dir):
    """Edges refitted for every fold on the other folds (one aggregate keyed by fold), applied to the fold."""
    w = wide(spark, sf_dir).filter(TRAIN()).withColumn("fold", C.hash_bucket(5, "id", seed=7))
    edges = fit_quantile_edges(w, "a2", 5, fold_col="fold", k=5)
    return apply_quantile_bins(w, "a2", edges, "a2_bin", fold_col="fold", k=5).select("id", "fold", "a2_bin")


@register("j_age_bins_left", "J3", sql=f"SELECT id, {age_group_sql('age')} AS age_group FROM w")
def j_age_bins_left(spark, sf_dir):
    """Fixed left-closed age bins, out of range and null -> Unknown."""
    return wide(spark, sf_dir).select("id", CF.age_group(F.col("age")).alias("age_group"))


# Fixed values of the reference's right-closed bins.
AGE_EDGES_R = [-1, 12, 18, 25, 40, 60, 100]
AGE_LABELS_R = ["child", "teen", "young", "adult", "mature", "senior"]
NUM_EDGES_R = [-1, 300, 600, 900, 1200, 1500, 2000]
NUM_LABELS_R = ["0000_0300", "0301_0600", "0601_0900", "0901_1200", "1201_1500", "1501_2000"]


def _rbins_sql(c: str, edges, labels) -> str:
    parts = " ".join(f"WHEN {c} > {lo} AND {c} <= {hi} THEN '{lab}'" for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"CASE {parts} END"


def _rcode_sql(c: str, edges, labels) -> str:
    parts = " ".join(f"WHEN {c} > {lo} AND {c} <= {hi} THEN {i}" for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])))
    return f"CAST(CASE {parts} ELSE -1 END AS INTEGER)"


@register(
    "j_fixed_bins_right", "J4",
    sql=f"""SELECT id, {_rbins_sql('age', AGE_EDGES_R, AGE_LABELS_R)} AS age_bin,
            {_rbins_sql('a2 / 100', NUM_EDGES_R, NUM_LABELS_R)} AS a2_bin, {_rcode_sql('a2 / 100', NUM_EDGES_R, NUM_LABELS_R)} AS a2_bin_code
            FROM w""",
)
def j_fixed_bins_right(spark, sf_dir):
    """Right-closed fixed bins (outside -> null) and the bin's integer code (-1 for none)."""
    w = wide(spark, sf_dir)
    x = F.col("a2") / 100
    code = None
    for i, (lo, hi) in enumerate(zip(NUM_EDGES_R[:-1], NUM_EDGES_R[1:])):
        cond = (x > lo) & (x <= hi)
        code = F.when(cond, F.lit(i)) if code is None else code.when(cond, F.lit(i))
    return w.select(
        "id",
        fixed_bins(F.col("age"), AGE_EDGES_R, AGE_LABELS_R, right=True, unknown=None).alias("age_bin"),
        fixed_bins(x, NUM_EDGES_R, NUM_LABELS_R, right=True, unknown=None).alias("a2_bin"),
        code.otherwise(F.lit(-1)).cast("int").alias("a2_bin_code"),
    )


@register(
    "j_count_bucket", "J5",
    sql=with_wk("""
    WITH c AS (SELECT surname, count(*) AS n FROM wk WHERE split = 'train' AND surname IS NOT NULL GROUP BY surname),
    f AS (SELECT id, coalesce(c.n, 0) AS freq FROM wk LEFT JOIN c ON wk.surname = c.surname)
    SELECT id, CASE WHEN freq <= 0 THEN 'Freq_0' WHEN freq = 1 THEN 'Freq_1' WHEN freq = 2 THEN 'Freq_2'
                    WHEN freq <= 4 THEN 'Freq_3_4' WHEN freq <= 7 THEN 'Freq_5_7' ELSE 'Freq_8_plus' END AS freq_bucket,
           CAST(freq <= 1 AS INTEGER) AS is_rare, CAST(freq >= 8 AS INTEGER) AS is_frequent
    FROM f"""),
)
def j_count_bucket(spark, sf_dir):
    """Surname frequency buckets with rare / frequent flags (frequency fitted on train)."""
    w = keyed(wide(spark, sf_dir))
    st = w.filter(TRAIN() & F.col("surname").isNotNull()).groupBy("surname").agg(F.count(F.lit(1)).alias("freq"))
    f = lookup(w, st, ["surname"]).withColumn("freq", F.coalesce("freq", F.lit(0)))
    return f.select("id", count_bucket(F.col("freq")).alias("freq_bucket"),
                    (F.col("freq") <= 1).cast("int").alias("is_rare"), (F.col("freq") >= 8).cast("int").alias("is_frequent"))


@register(
    "j_log1p", "J6",
    sql="SELECT id, " + ", ".join(f"round(ln(1 + greatest({a}, 0.0)), 6) AS {a}_log" for a in A) + " FROM w",
)
def j_log1p(spark, sf_dir):
    """log1p of the amounts, clipped at 0 first."""
    return rounded(wide(spark, sf_dir).select("id", *[C.log1p_clipped(a).alias(f"{a}_log") for a in A]))


def _exact_mean_sql(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(38,4))) AS DOUBLE) / count({c})"


@register(
    "j_standard_scale", "J7",
    sql="WITH s AS (SELECT " + ", ".join(
        f"{_exact_mean_sql(a)} AS m_{a}, stddev_pop({a}) AS s_{a}" for a in A) + " FROM w WHERE split = 'train') SELECT id, "
        + ", ".join(f"round(({a} - m_{a}) / CASE WHEN s_{a} IS NULL OR s_{a} = 0 THEN 1.0 ELSE s_{a} END, 6) AS {a}_std" for a in A)
        + " FROM w, s",
)
def j_standard_scale(spark, sf_dir):
    """Train-fit standard scaling with the population std; constant column divides by 1."""
    return rounded(TR.standard_scale(wide(spark, sf_dir), A, TRAIN()).select("id", *[f"{a}_std" for a in A]))


@register(
    "j_minmax_scale", "J8",
    sql="WITH s AS (SELECT " + ", ".join(f"min({a}) AS lo_{a}, max({a}) AS hi_{a}" for a in A)
        + " FROM w WHERE split = 'train') SELECT id, split, "
        + ", ".join(f"round(({a} - lo_{a}) / CASE WHEN hi_{a} - lo_{a} = 0 THEN 1.0 ELSE hi_{a} - lo_{a} END, 6) AS {a}_mm" for a in A)
        + " FROM w, s",
)
def j_minmax_scale(spark, sf_dir):
    """Train min/max scaling; test rows are not clipped."""
    return rounded(TR.minmax_scale(wide(spark, sf_dir), A, TRAIN()).select("id", "split", *[f"{a}_mm" for a in A]))


_MM = "mm AS (SELECT min(a2) AS lo, CASE WHEN max(a2) - min(a2) = 0 THEN 1.0 ELSE max(a2) - min(a2) END AS rng FROM w WHERE split = 'train')"
_X = "greatest((a2 - lo) / rng, 0.0)"
_POWER_SQL = {
    "a2": "a2", "log_a2": "CASE WHEN (a2 - lo) / rng > -1 THEN ln(1 + (a2 - lo) / rng) END", "sqrt_a2": f"sqrt({_X})", "pow_a2": f"pow({_X}, 0.25)",
    "pow2_a2": f"pow({_X}, 0.1)", "log_pow2_a2": f"ln(1 + pow({_X}, 0.1))",
}
_POWER_SQL = {n: f"CASE WHEN a2 IS NULL THEN 0.0 ELSE coalesce({e}, 0.0) END" for n, e in _POWER_SQL.items()}


@register(
    "j_power", "J9",
    sql=f"WITH {_MM} SELECT id, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in _POWER_SQL.items()) + " FROM w, mm",
)
def j_power(spark, sf_dir):
    """Log, square, fourth and tenth root and log of the tenth root of the train-scaled column; nulls are 0."""
    return rounded(FE.power_features(wide(spark, sf_dir), "a2", TRAIN()).select("id", *_POWER_SQL))


# a2_up is the train-scaled a2 plus 1, as Box-Cox takes it; a2_far has its best lambda far outside [-2, 2]
_POWERS = {"a1": "yeo-johnson", "a3": "yeo-johnson", "age": "yeo-johnson", "a2_up": "box-cox", "a2_far": "box-cox"}
_POWER_EXTRA = {"a2_up": "(a2 - lo) / rng + 1.0", "a2_far": "(a2 - lo) / rng + 10.0"}


def _kernel_sql(method: str, v: str, lam: str) -> str:
    if method == "box-cox":
        return f"CASE WHEN {v} > 0 THEN CASE WHEN {lam} = 0 THEN ln({v}) ELSE pow({v}, {lam}) / {lam} END END"
    return (f"CASE WHEN {v} >= 0 THEN CASE WHEN {lam} = 0 THEN ln(1 + {v}) ELSE pow({v} + 1.0, {lam}) / {lam} END "
            f"ELSE CASE WHEN {lam} = 2 THEN -ln(1 - {v}) ELSE -(pow(1.0 - {v}, 2.0 - {lam}) - 1.0) / (2.0 - {lam}) END + CASE WHEN {lam} = 0 THEN 0.0 ELSE 1.0 / {lam} END END")


def _power_fit_sql(columns: dict[str, str], rows: str, moves: int = 1) -> str:
    """CTEs up to ``fitted`` (column_name, method, lam, center, std): the likelihood of every candidate, round by round.

    ``moves`` is how often the coarse grid may move to its outermost candidate.
    """
    x = " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{m}' AS method, CAST({c} AS DOUBLE) AS v FROM {rows} WHERE {c} IS NOT NULL" for c, m in columns.items())
    kernel = f"CASE method WHEN 'box-cox' THEN {_kernel_sql('box-cox', 'v', 'lam')} ELSE {_kernel_sql('yeo-johnson', 'v', 'lam')} END"
    ctes = [f"px AS MATERIALIZED ({x})", "pj AS (SELECT column_name, method, count(*) AS n, sum(CASE method WHEN 'box-cox' THEN ln(v) ELSE sign(v) * ln(1 + abs(v)) END) AS j FROM px GROUP BY ALL)",
            "p0 AS (SELECT column_name, 0.0::DOUBLE AS lam FROM pj)"]
    rounds = [("1.0", TR.FIRST_STEPS)] * moves + [(f"(1.0 / {8 ** k}.0)", TR.LATER_STEPS) for k in range(1, TR.ROUNDS + 1)]
    for k, (step, steps) in enumerate(rounds):
        ctes.append(f"""p{k + 1} AS MATERIALIZED (SELECT column_name, arg_max(lam, llf) AS lam FROM (
            SELECT column_name, lam, -any_value(n) / 2.0 * ln(var_pop({kernel})) + (lam - 1.0) * any_value(j) AS llf
            FROM (SELECT column_name, lam + i * {step} AS lam FROM p{k}, range({steps[0]}, {steps[-1] + 1}) t(i)) JOIN pj USING (column_name) JOIN px USING (column_name, method)
            GROUP BY column_name, lam) GROUP BY column_name)""")
    ctes.append(f"fitted AS MATERIALIZED (SELECT column_name, method, lam, avg({kernel}) AS center, stddev_pop({kernel}) AS std FROM px JOIN p{len(rounds)} USING (column_name) GROUP BY ALL)")
    return ",\n    ".join(ctes)


_POWER_ROWS_SQL = f"pw AS (SELECT w.*, {', '.join(f'{e} AS {n}' for n, e in _POWER_EXTRA.items())} FROM w, mm), pt AS (SELECT * FROM pw WHERE split = 'train')"
_POWER_FIT_SQL = f"{_MM}, {_POWER_ROWS_SQL}, {_power_fit_sql(_POWERS, 'pt', moves=9)}"


def _power_rows(spark, sf_dir):
    w = TR.minmax_scale(wide(spark, sf_dir), ["a2"], TRAIN())
    return w.withColumns({"a2_up": F.col("a2_mm") + 1.0, "a2_far": F.col("a2_mm") + 10.0})


@register(
    "j_power_fit", "J10",
    sql=f"WITH {_POWER_FIT_SQL} SELECT column_name, method, round(lam, 6) AS lambda FROM fitted",
)
def j_power_fit(spark, sf_dir):
    """Lambda of Yeo-Johnson and Box-Cox by maximum likelihood, also far outside [-2, 2]."""
    fits = TR.fit_power(_power_rows(spark, sf_dir), _POWERS, TRAIN())
    rows = [(c, f.method, f.lam) for c, f in fits.items()]
    return rounded(spark.createDataFrame(rows, "column_name string, method string, lambda double"))


_APPLIED = ["a1", "a3", "age", "a2_up"]


@register(
    "j_power_apply", "J10",
    sql=f"WITH {_POWER_FIT_SQL} SELECT id, " + ", ".join(
        f"round(CASE WHEN {c} IS NOT NULL THEN coalesce(({_kernel_sql(_POWERS[c], c, f'f{i}.lam')} - f{i}.center) / f{i}.std, 0.0) END, 6) AS {c}_power" for i, c in enumerate(_APPLIED))
        + " FROM pw, " + ", ".join(f"(SELECT * FROM fitted WHERE column_name = '{c}') f{i}" for i, c in enumerate(_APPLIED)),
)
def j_power_apply(spark, sf_dir):
    """The standardised transforms with the fitted lambdas, on train and test rows."""
    w = _power_rows(spark, sf_dir)
    fits = TR.fit_power(w, {c: _POWERS[c] for c in _APPLIED}, TRAIN())
    return rounded(w.select("id", *[TR.power_column(c, fits[c]).alias(f"{c}_power") for c in _APPLIED]))


@register(
    "j_ratios", "J11",
    sql=with_wk("""
    WITH g AS (SELECT *, count(*) OVER (PARTITION BY group_id) AS gs FROM wk),
    r AS (SELECT *, coalesce(a4, 0.0) + coalesce(a5, 0.0) AS lux, coalesce(a1, 0.0) + coalesce(a2, 0.0) + coalesce(a3, 0.0) AS bas FROM g)
    SELECT id, round(coalesce(total / nullif(age + 1.0, 0.0), 0.0), 6) AS spend_per_age, round(coalesce(total / gs, 0.0), 6) AS spend_per_member,
           round(lux - bas, 6) AS lux_minus_basic, round(coalesce(lux / nullif(bas + 1.0, 0.0), 0.0), 6) AS lux_to_basic,
           CAST(coalesce(flag = 'True', false) AND total > 0 AS INTEGER) AS flag_spender
    FROM r"""),
)
def j_ratios(spark, sf_dir):
    """Spend per age and per group member, luxury minus / over basic, anomaly flag."""
    w = keyed(wide(spark, sf_dir))
    w = FE.group_transform(w, ["group_id"], {"group_size": F.count(F.lit(1))})
    out = FE.ratio_features(w, A, ["a4", "a5"], ["a1", "a2", "a3"], "age", "group_size", "flag")
    return rounded(out.select("id", "spend_per_age", "spend_per_member", "lux_minus_basic", "lux_to_basic", "flag_spender"))


_RULE_SQL = {
    "all_known": "CAST(" + " AND ".join(f"{a} IS NOT NULL" for a in A) + " AS INTEGER)",
    "known_total": "round(" + " + ".join(f"coalesce({a}, 0.0)" for a in A) + ", 6)",
    "has_known_positive": "CAST(" + " OR ".join(f"coalesce({a} > 0, false)" for a in A) + " AS INTEGER)",
    "strict_zero": "CAST(" + " AND ".join(f"{a} IS NOT NULL" for a in A) + " AND (" + " + ".join(f"coalesce({a}, 0.0)" for a in A) + ") = 0 AS INTEGER)",
    "flag_conflict": "CAST(coalesce(flag = 'True', false) AND (" + " OR ".join(f"coalesce({a} > 0, false)" for a in A) + ") AS INTEGER)",
    "missing_amounts": " + ".join(f"CAST({a} IS NULL AS INTEGER)" for a in A),
    "flag_x_zero": "CAST(coalesce(flag = 'True', false) AND (" + " + ".join(f"coalesce({a}, 0.0)" for a in A) + ") = 0 AS INTEGER)",
    "flag_x_strict_zero": "CAST(coalesce(flag = 'True', false) AND " + " AND ".join(f"{a} IS NOT NULL" for a in A)
                          + " AND (" + " + ".join(f"coalesce({a}, 0.0)" for a in A) + ") = 0 AS INTEGER)",
    "flag_x_spend_count": "CAST(coalesce(flag = 'True', false) AS INTEGER) * (" + " + ".join(f"CAST(coalesce({a} > 0, false) AS INTEGER)" for a in A) + ")",
}


@register("j_rule_features", "J12", sql="SELECT id, " + ", ".join(f"{e} AS {n}" for n, e in _RULE_SQL.items()) + " FROM w")
def j_rule_features(spark, sf_dir):
    """Raw rule features and flag x amount interactions."""
    return rounded(FE.rule_features(wide(spark, sf_dir), A, "flag").select("id", *_RULE_SQL))


@register(
    "j_one_hot", "J13",
    sql="""
    WITH lv AS (SELECT list(DISTINCT home ORDER BY home) AS levels FROM w WHERE split = 'train' AND home IS NOT NULL)
    SELECT id, list_transform(levels, lambda l: coalesce(CAST(w.home = l AS DOUBLE), 0.0)) AS home_ohe FROM w, lv""",
)
def j_one_hot(spark, sf_dir):
    """One-hot of home with train levels; unseen and null -> all zeros (Spark ML indexer + encoder)."""
    return EN.one_hot(wide(spark, sf_dir), "home", fit_on=TRAIN()).select("id", "home_ohe")


@register(
    "j_ordinal", "J14",
    sql="""
    WITH lv AS (SELECT column_name, level, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY level) - 1 AS INTEGER) AS idx
                FROM (SELECT DISTINCT 'dest' AS column_name, dest AS level FROM w WHERE split = 'train' AND dest IS NOT NULL
                      UNION SELECT DISTINCT 'code', code FROM w WHERE split = 'train' AND code IS NOT NULL) t)
    SELECT id, coalesce(d.idx, -1) AS dest_ord, coalesce(c.idx, -1) AS code_ord
    FROM w LEFT JOIN lv d ON d.column_name = 'dest' AND w.dest = d.level
           LEFT JOIN lv c ON c.column_name = 'code' AND w.code = c.level""",
)
def j_ordinal(spark, sf_dir):
    """Alphabetical index fitted on train; unseen and null -> -1."""
    w = wide(spark, sf_dir)
    levels = EN.level_index(w, ["dest", "code"], fit_on=TRAIN())
    return EN.ordinal_encode(w, ["dest", "code"], levels).select("id", "dest_ord", "code_ord")


@register(
    "j_native_index", "J15/J16",
    sql=with_wk("""
    WITH lv AS (SELECT column_name, level, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY level) - 1 AS INTEGER) AS idx
                FROM (SELECT DISTINCT 'home' AS column_name, home AS level FROM wk WHERE home IS NOT NULL
                      UNION SELECT DISTINCT 'surname', surname FROM wk WHERE surname IS NOT NULL
                      UNION SELECT DISTINCT 'member', CAST(member AS VARCHAR) FROM wk WHERE member IS NOT NULL) t)
    SELECT id, coalesce(h.idx, -1) AS home_ord, coalesce(s.idx, -1) AS surname_ord, coalesce(m.idx, -1) AS member_ord
    FROM wk LEFT JOIN lv h ON h.column_name = 'home' AND wk.home = h.level
            LEFT JOIN lv s ON s.column_name = 'surname' AND wk.surname = s.level
            LEFT JOIN lv m ON m.column_name = 'member' AND CAST(wk.member AS VARCHAR) = m.level"""),
)
def j_native_index(spark, sf_dir):
    """Shared level index over every split; strings (incl. surname, member as text) as categories."""
    w = keyed(wide(spark, sf_dir)).withColumn("member", F.col("member").cast("string"))
    return EN.native_index(w, ["home", "surname", "member"]).select("id", "home_ord", "surname_ord", "member_ord")


@register("j_dense_matrix", "J17")
def j_dense_matrix(spark, sf_dir):
    """Scaled numerics of the imputed frame + one-hot of every fitted level in one float32 array; a null in it raises."""
    w = TR.standard_scale(CF.build(wide(spark, sf_dir)), A, TRAIN())
    w = EN.one_hot(w, "home", fit_on=TRAIN())
    dense = F.concat(F.array(*[F.col(f"{a}_std") for a in A]), F.col("home_ohe"))
    audited = F.when(F.coalesce(F.exists(dense, F.isnull), F.lit(True)), F.raise_error(F.lit("null in the dense matrix"))).otherwise(dense)
    return w.select("id", audited.cast("array<float>").alias("features"))


def _te_sql(col: str, kind: str) -> str:
    lv = f"coalesce(CAST({col} AS VARCHAR), '__MISSING__')"
    base = f"""
    fit_{col} AS (SELECT id, {lv} AS lv, y FROM w WHERE split = 'train'),
    g_{col} AS (SELECT avg(y) AS g FROM fit_{col}),
    st_{col} AS (SELECT lv, sum(y) AS s, count(*) AS n FROM fit_{col} GROUP BY lv)"""
    return base


@register(
    "j_target_smooth", "J18",
    sql="WITH " + ",".join(_te_sql(c, "plain") for c in ("dest", "code")) + "\nSELECT id, " + ", ".join(
        f"round(coalesce((st_{c}.s + g_{c}.g * 20.0) / (st_{c}.n + 20.0), g_{c}.g), 6) AS te_{c}" for c in ("dest", "code"))
        + " FROM w " + " ".join(
        f"LEFT JOIN st_{c} ON coalesce(CAST(w.{c} AS VARCHAR), '__MISSING__') = st_{c}.lv CROSS JOIN g_{c}" for c in ("dest", "code")),
)
def j_target_smooth(spark, sf_dir):
    """Smoothed target encoding (m = 20) fitted on train; unseen -> prior; null is a level."""
    w = wide(spark, sf_dir)
    w = EN.target_encode(w, "dest", "y", TRAIN())
    w = EN.target_encode(w, "code", "y", TRAIN())
    return rounded(w.select("id", "te_dest", "te_code"))


@register(
    "j_target_loo", "J19",
    sql="WITH " + _te_sql("dest", "loo") + """
    SELECT id, round(CASE WHEN split = 'train' THEN
             CASE WHEN st_dest.n - 1 + 20.0 > 0 THEN (st_dest.s - y + g_dest.g * 20.0) / (st_dest.n - 1 + 20.0) ELSE g_dest.g END
           ELSE coalesce((st_dest.s + g_dest.g * 20.0) / (st_dest.n + 20.0), g_dest.g) END, 6) AS te_dest
    FROM w LEFT JOIN st_dest ON coalesce(CAST(w.dest AS VARCHAR), '__MISSING__') = st_dest.lv CROSS JOIN g_dest""",
)
def j_target_loo(spark, sf_dir):
    """Leave-one-out encoding on train rows (leaks the label; comparison only), plain on test."""
    w = EN.target_encode_loo(wide(spark, sf_dir), "dest", "y", TRAIN())
    return rounded(w.select("id", "te_dest"))


_IFOLD = sql_hash_bucket(5, "id", seed=1)


@register(
    "j_target_oof", "J20",
    sql=f"""
    WITH b AS (SELECT id, split, y, coalesce(CAST(dest AS VARCHAR), '__MISSING__') AS lv, {_IFOLD} AS fold FROM w),
    fit AS (SELECT * FROM b WHERE split = 'train'),
    pf AS (SELECT lv, fold, sum(y) AS s, count(*) AS n FROM fit GROUP BY lv, fold),
    tot AS (SELECT lv, sum(s) AS S, sum(n) AS N FROM pf GROUP BY lv),
    gf AS (SELECT fold, sum(y) AS gs, count(*) AS gn FROM fit GROUP BY fold),
    ga AS (SELECT sum(y) AS GS, count(*) AS GN FROM fit)
    SELECT id, round(CASE WHEN split = 'train' THEN
        CASE WHEN tot.N - coalesce(pf.n, 0) > 0
             THEN ((tot.S - coalesce(pf.s, 0.0)) + ((ga.GS - gf.gs) / (ga.GN - gf.gn)) * 20.0) / ((tot.N - coalesce(pf.n, 0)) + 20.0)
             ELSE ga.GS / ga.GN END
      ELSE coalesce((tot.S + (ga.GS / ga.GN) * 20.0) / (tot.N + 20.0), ga.GS / ga.GN) END, 6) AS te_dest
    FROM b LEFT JOIN tot ON b.lv = tot.lv LEFT JOIN pf ON b.lv = pf.lv AND b.fold = pf.fold
           LEFT JOIN gf ON b.fold = gf.fold CROSS JOIN ga""",
)
def j_target_oof(spark, sf_dir):
    """Out-of-fold encoding (5 inner folds): total - own fold, no loop; test rows from all train rows."""
    w = wide(spark, sf_dir).withColumn("fold", C.hash_bucket(5, "id", seed=1))
    return rounded(EN.target_encode_oof(w, "dest", "y", TRAIN(), "fold").select("id", "te_dest"))


def _catstats_sql(c: str) -> str:
    return f"""
    st_{c} AS (SELECT {c}, avg(quality) AS m, count(*) AS cnt, sum(quality) AS pos FROM d2 WHERE fit AND {c} IS NOT NULL GROUP BY {c}),
    r_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY m, {c}) - 1 AS INTEGER) AS {c}_target,
                     round(ln(1 + cnt), 6) AS {c}_count,
                     CAST(count(*) OVER () - row_number() OVER (ORDER BY cnt DESC, {c}) + 1 AS INTEGER) AS {c}_count_label,
                     round(ln(1 + pos / CASE WHEN cnt - pos = 0 THEN NULL ELSE cnt - pos END), 6) AS {c}_woe FROM st_{c})"""


_CS = ["lang", "source"]


@register(
    "j_category_stats", "J21-J23",
    sql=f"WITH d2 AS (SELECT *, {sql_hash_bucket(5, 'doc_id')} <> 0 AS fit FROM d)," + ",".join(_catstats_sql(c) for c in _CS)
        + "\nSELECT doc_id, " + ", ".join(f"r_{c}.{c}_{k}" for c in _CS for k in ("target", "count", "count_label", "woe"))
        + " FROM d2 " + " ".join(f"LEFT JOIN r_{c} ON d2.{c} = r_{c}.{c}" for c in _CS),
    fixtures=("d",),
)
def j_category_stats(spark, sf_dir):
    """Target-order, log-count, count-rank and weight-of-evidence encodings of lang and source (label = quality)."""
    d = labelled_documents(spark, sf_dir).withColumn("fit", C.hash_bucket(5, "doc_id") != 0)
    for c in _CS:
        d = EN.category_stat_encodings(d, c, "quality", F.col("fit"))
    return rounded(d.select("doc_id", *[f"{c}_{k}" for c in _CS for k in ("target", "count", "count_label", "woe")]))


@register(
    "j_tfidf", "J24",
    sql=r"""
    WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
    st AS (SELECT term, sum(tf) AS tot, count(*) AS df FROM tf GROUP BY term),
    nd AS (SELECT count(*) AS nd FROM documents),
    vocab AS (SELECT term, ln((1 + nd) / (1 + df)) + 1 AS idf FROM st, nd ORDER BY tot DESC, term LIMIT 1000),
    v AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
    nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM v GROUP BY doc_id)
    SELECT doc_id, term, round(w / nrm, 6) AS weight FROM v JOIN nrm USING (doc_id)""",
    fixtures=(),
)
def j_tfidf(spark, sf_dir):
    """TF-IDF over whole document texts: 1000-term vocabulary, smooth idf, L2-normalised rows (long form)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return rounded(EN.tfidf(docs, "doc_id", "text"))


@register("j_tfidf_svd", "J25")
def j_tfidf_svd(spark, sf_dir):
    """Truncated SVD (5 components) of the TF-IDF matrix, every document projected (distributed RowMatrix)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return rounded(EN.tfidf_svd(materialize(EN.tfidf(docs, "doc_id", "text"), "tfidf"), "doc_id", docs, k=5))


@register(
    "j_tfidf_transform", "J24",
    sql=rf"""
    WITH t AS (SELECT doc_id, {sql_hash_bucket(5, 'doc_id')} <> 0 AS fit, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM documents),
    tf AS (SELECT doc_id, fit, term, count(*) AS tf FROM t GROUP BY doc_id, fit, term),
    st AS (SELECT term, sum(tf) AS tot, count(*) AS df FROM tf WHERE fit GROUP BY term),
    nd AS (SELECT count(*) AS nd FROM documents WHERE {sql_hash_bucket(5, 'doc_id')} <> 0),
    vocab AS (SELECT term, ln((1 + nd) / (1 + df)) + 1 AS idf FROM st, nd ORDER BY tot DESC, term LIMIT 1000),
    v AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
    nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM v GROUP BY doc_id)
    SELECT doc_id, term, round(w / nrm, 6) AS weight FROM v JOIN nrm USING (doc_id)""",
    fixtures=(),
)
def j_tfidf_transform(spark, sf_dir):
    """Vocabulary and idf fitted on four of five hash folds, applied to every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return rounded(EN.tfidf(docs, "doc_id", "text", fit_on=C.hash_bucket(5, "doc_id") != 0))


_UFOLD = sql_hash_bucket(10, "id", seed=42)


_BX, _YJ = ("bx_cx_a2", "box-cox", "(a2 - lo) / rng + 1.0"), ("y_J_a2", "yeo-johnson", "a2")
_NINE = ["a2", "log_a2", "sqrt_a2", "bx_cx_a2", "y_J_a2", "pow_a2", "pow2_a2", "log_pow2_a2"]


def _nine_sql() -> str:
    """CTEs up to ``nine``: the eight variants, Gram matrix, power iteration and the first component."""
    fitted = {n: f"CASE WHEN a2 IS NULL THEN 0.0 ELSE coalesce(({_kernel_sql(m, e, f'{n}_f.lam')} - {n}_f.center) / {n}_f.std, 0.0) END" for n, m, e in (_BX, _YJ)}
    every = _POWER_SQL | fitted
    sums = "[" + ", ".join("[" + ", ".join(f"sum(x[{i + 1}] * x[{j + 1}])" for j in range(8)) + "]" for i in range(8)) + "]"
    ctes = [
        "ut AS (SELECT w.*, (a2 - lo) / rng + 1.0 AS bx_cx_a2, a2 AS y_J_a2, lo, rng FROM w, mm WHERE split = 'train')",
        _power_fit_sql({n: m for n, m, _ in (_BX, _YJ)}, "ut"),
        f"""eight AS MATERIALIZED (SELECT id, y, {_UFOLD} AS fold, [{", ".join(every[n] for n in _NINE)}] AS x FROM (SELECT id, y, a2, lo, rng FROM ut),
            (SELECT * FROM fitted WHERE column_name = 'bx_cx_a2') bx_cx_a2_f, (SELECT * FROM fitted WHERE column_name = 'y_J_a2') y_J_a2_f)""",
        f"gram AS MATERIALIZED (SELECT {sums} AS g FROM eight)",
        "u0 AS (SELECT [1.0::DOUBLE, 1, 1, 1, 1, 1, 1, 1] AS u)",
    ]
    for k in range(12):
        ctes.append(f"u{k + 1} AS MATERIALIZED (SELECT list_transform(h, lambda q: q / sqrt(list_dot_product(h, h))) AS u FROM (SELECT list_transform(g, lambda r: list_dot_product(r, u)) AS h FROM gram, u{k}))")
    ctes.append("nine AS MATERIALIZED (SELECT id, y, fold, list_append(x, list_dot_product(x, u)) AS x FROM eight, u12)")
    return ",\n    ".join(ctes)


@register(
    "j_univariate_winner", "J26",
    sql=f"""
    WITH {_MM}, {_nine_sql()},
    l AS ({" UNION ALL ".join(f"SELECT '{n}' AS v, {k} AS place, fold, CAST(y AS DOUBLE) AS y, x[{k + 1}] AS x FROM nine" for k, n in enumerate([*_NINE, 'a2_pca_comb']))}),
    pf AS (SELECT v, fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy FROM l GROUP BY v, fold),
    tot AS (SELECT v, sum(n) AS tn, sum(sx) AS tsx, sum(sy) AS tsy, sum(sxy) AS tsxy FROM pf GROUP BY v),
    dir AS (SELECT pf.v, pf.fold, sign((tsxy - sxy) - (tsx - sx) * (tsy - sy) / (tn - n)) AS d FROM pf JOIN tot USING (v)),
    d2 AS (SELECT l.v, l.fold, l.x * d AS xp, sum(y) AS pos, sum(1 - y) AS neg FROM l JOIN dir USING (v, fold) GROUP BY l.v, l.fold, l.x * d),
    c AS (SELECT *, sum(pos) OVER w - pos AS tp, sum(neg) OVER w - neg AS fp FROM d2
          WINDOW w AS (PARTITION BY v, fold ORDER BY xp DESC ROWS UNBOUNDED PRECEDING)),
    per AS (SELECT v, fold, sum(pos) AS P, sum(neg) AS N, max(tp - fp) AS g FROM c GROUP BY v, fold)
    , acc AS (SELECT v, avg((greatest(g, 0.0) + N) / (P + N)) AS a FROM per GROUP BY v), o AS (SELECT DISTINCT v, place FROM l)
    SELECT v AS variant, round(a, 6) AS cv_accuracy,
           row_number() OVER (ORDER BY floor(a * 1e9 + 0.5) DESC, place) = 1 AS winner FROM acc JOIN o USING (v)""",
)
def j_univariate_winner(spark, sf_dir):
    """10-fold one-feature logistic accuracy of a2 and its eight variants, the winner and (the others) the drop list."""
    w, names = FE.all_power_features(wide(spark, sf_dir).select("id", "y", "split", "a2"), "a2", TRAIN())
    w = w.filter(TRAIN()).withColumn("fold", C.hash_bucket(10, "id", seed=42))
    return rounded(FE.univariate_cv_accuracy(w, {n: F.col(n) for n in names}, "y", "fold"))


@register(
    "j_component", "J26",
    sql=f"WITH {_MM}, {_nine_sql()} SELECT id, " + ", ".join(f"round(x[{k + 1}], 6) AS {n}" for k, n in enumerate([*_NINE, "a2_pca_comb"])) + " FROM nine",
)
def j_component(spark, sf_dir):
    """The nine variants of a2 on the train rows: fitted power transforms and the first component among them."""
    w, names = FE.all_power_features(wide(spark, sf_dir).select("id", "y", "split", "a2"), "a2", TRAIN())
    return rounded(w.where(TRAIN()).select("id", *names))
