"""Feature operators: branch column sets, row-wise math, group transforms.

Group transforms are a grouped aggregate joined back on the key, not a
window: the aggregate is combined map-side, so a hot group (a third of the
rows under one key) collapses to one row per task before the shuffle, and
the join back is a broadcast when the statistics are small or a sort-merge
join that AQE splits when one key is skewed.  A window would instead sort a
hot group inside one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators.core import lookup, materialize, ordered_index

AMOUNTS = ["a1", "a2", "a3", "a4", "a5"]
NUMERIC = ["age", "a1", "a2", "a3", "a4", "a5", "member_no"]
CATEGORICAL = ["home", "dest", "vip", "flag"]

# Column lists per model branch (B8), expressed on fixture W's roles.
FEATURE_SETS: dict[str, list[str]] = {
    "lr": NUMERIC + CATEGORICAL,
    "rf": NUMERIC + ["home", "vip", "flag"],
    "hgb": NUMERIC + ["home"],
    "xgb": NUMERIC + CATEGORICAL + ["code"],
    "lgbm": NUMERIC + CATEGORICAL + ["code"],
    "cat": NUMERIC + CATEGORICAL + ["code", "name"],
    "knn": NUMERIC,
}

#: Every column that a branch may select.
EVERY_FEATURE = ["member_no", "home", "dest", "vip", "flag", "code", "age", *AMOUNTS, "name"]

#: Switchable column families of the boosted-tree branch (B9), on the common frame, and their defaults.
OPTION_FAMILIES: dict[str, list[str]] = {
    "include_group": ["group_size", "is_solo", "is_leader"],
    "include_cabin": ["num", "deck_side", "num_bin"],
    "include_spend": ["luxury", "basic", "luxury_share", "spend_per_active", "spend_count"],
    "include_surname_features": ["surname_freq"],
    "include_surname": ["surname"],
}
OPTION_DEFAULTS = {o: o != "include_surname" for o in OPTION_FAMILIES}
OPTION_BASE = ["age", *AMOUNTS, "total", "spend_count", "home", "dest", "vip", "flag", "deck", "side", "age_group", "num_bin"]

EXTRA_MODES = ["none", "logs_only", "summary_only", "all"]


def feature_columns(branch: str) -> list[str]:
    return list(FEATURE_SETS[branch])


def feature_spec(branch: str, columns: Sequence[str]) -> dict[str, list[str]]:
    """A branch's numeric, categorical and dropped columns among ``columns``; one that it selects and isn't there raises."""
    chosen = feature_columns(branch)
    absent = [c for c in chosen if c not in columns]
    if absent:
        raise ValueError(f"branch {branch} needs {absent}")
    numeric = [c for c in chosen if c in NUMERIC]
    return {"numeric": numeric, "categorical": [c for c in chosen if c not in NUMERIC], "dropped": [c for c in columns if c not in chosen]}


def resolve_options(options: Mapping[str, object] | None) -> dict[str, bool]:
    """The defaults with the known options switched; unknown names are ignored."""
    return {o: bool(options[o]) if options and o in options else d for o, d in OPTION_DEFAULTS.items()}


def optional_columns(options: Mapping[str, bool]) -> list[str]:
    """The base columns and those of the families that are on, each once, in the order of first mention."""
    names = [*OPTION_BASE, *[c for o, family in OPTION_FAMILIES.items() if options[o] for c in family]]
    return list(dict.fromkeys(names))


def extra_columns(mode: str, amounts: Sequence[str] = AMOUNTS) -> dict[str, Column]:
    """Extra numeric features by mode (none / logs_only / summary_only / all)."""
    logs = {f"{a}_log": C.log1p_clipped(a) for a in amounts}
    summary = {
        "amount_total": C.row_sum(amounts),
        "amount_max": C.row_max(amounts),
        "amount_npos": C.row_count_positive(amounts).cast("double"),
    }
    return {"none": {}, "logs_only": logs, "summary_only": summary, "all": {**logs, **summary}}[mode]


def extra_columns_sql(mode: str, amounts: Sequence[str] = AMOUNTS) -> dict[str, str]:
    logs = {f"{a}_log": f"ln(1 + greatest({a}, 0.0))" for a in amounts}
    summary = {
        "amount_total": " + ".join(f"coalesce({a}, 0.0)" for a in amounts),
        "amount_max": f"greatest({', '.join(amounts)})",
        "amount_npos": "CAST(" + " + ".join(f"coalesce(CAST({a} > 0 AS INTEGER), 0)" for a in amounts) + " AS DOUBLE)",
    }
    return {"none": {}, "logs_only": logs, "summary_only": summary, "all": {**logs, **summary}}[mode]


# ------------------------------------------------------------------ row-wise


def amount_features(df: DataFrame, amounts: Sequence[str], luxury: Sequence[str], basic: Sequence[str]) -> DataFrame:
    """Totals (skip-null and complete-case), group sums, count, std, max, shares."""
    total = C.row_sum(amounts)
    lux = C.row_sum(luxury)
    npos = C.row_count_positive(amounts)
    return df.withColumns({
        "total": total,
        "total_cc": C.row_sum(amounts, skip_null=False),
        "luxury": lux,
        "basic": C.row_sum(basic),
        "active_count": npos,
        "amount_std": C.row_std_pop(amounts),
        "amount_max": C.row_max(amounts),
        "nonzero_share": npos / F.lit(float(len(amounts))),
        "luxury_share": C.safe_ratio(lux, total + 1.0),
        "per_active": C.safe_ratio(total, F.when(npos == 0, F.lit(None)).otherwise(npos)),
        "has_luxury": (lux > 0).cast("int"),
    })


def power_variants(column: str, scaled: Column) -> dict[str, Column]:
    """A column and its transforms on the train-scaled value; what is null or not finite is 0."""
    x = F.greatest(scaled, F.lit(0.0))
    tenth = F.when(scaled.isNotNull(), F.pow(x, 0.10))
    variants = {
        column: F.col(column).cast("double"),
        f"log_{column}": F.log1p(scaled),
        f"sqrt_{column}": F.when(scaled.isNotNull(), F.sqrt(x)),
        f"pow_{column}": F.when(scaled.isNotNull(), F.pow(x, 0.25)),
        f"pow2_{column}": tenth,
        f"log_pow2_{column}": F.log1p(tenth),
    }
    return {n: F.when(F.abs(e) < float("inf"), e).otherwise(F.lit(0.0)) for n, e in variants.items()}


def power_features(df: DataFrame, column: str, fit_on: Column) -> DataFrame:
    """:func:`power_variants` of a column that is min-max scaled by its ``fit_on`` rows (others may fall outside)."""
    from tessera.operators.transforms import minmax_scale

    w = minmax_scale(df, [column], fit_on)
    return w.withColumns(power_variants(column, F.col(f"{column}_mm"))).drop(f"{column}_mm")


def all_power_features(df: DataFrame, column: str, fit_on: Column) -> tuple[DataFrame, list[str]]:
    """J26's nine variants of a column: J9's, the fitted Box-Cox and Yeo-Johnson transforms and the first component of all these.

    Box-Cox takes the train-scaled column plus 1; nulls and values without a transform are 0.  The component
    is the first right singular vector of the fit rows' variants (not centered), from their 8 x 8 Gram
    matrix, which is one aggregate; its largest loading is positive.
    """
    import numpy as np

    from tessera.operators.transforms import fit_power, minmax_scale, power_column

    w = minmax_scale(df, [column], fit_on).withColumn("__bx", F.col(f"{column}_mm") + 1.0).withColumn("__yj", F.col(column).cast("double"))
    fits = fit_power(w, {"__bx": "box-cox", "__yj": "yeo-johnson"}, fit_on)
    simple = power_variants(column, F.col(f"{column}_mm"))
    fitted = {f"bx_cx_{column}": power_column("__bx", fits["__bx"]), f"y_J_{column}": power_column("__yj", fits["__yj"])}
    names = [column, f"log_{column}", f"sqrt_{column}", *fitted, f"pow_{column}", f"pow2_{column}", f"log_pow2_{column}"]
    variants = simple | {n: F.coalesce(e, F.lit(0.0)) for n, e in fitted.items()}
    w = materialize(w.withColumns({n: variants[n] for n in names}).drop("__bx", "__yj", f"{column}_mm"), "variants")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = w.where(fit_on).agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"g{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((len(names), len(names)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"g{i}_{j}"] or 0.0
    loading = np.linalg.eigh(gram)[1][:, -1]
    loading = loading * (1.0 if loading[np.abs(loading).argmax()] >= 0 else -1.0)
    component = F.lit(0.0)
    for n, v in zip(names, loading.tolist()):
        component = component + F.col(n) * v
    return w.withColumn(f"{column}_pca_comb", component), [*names, f"{column}_pca_comb"]


def ratio_features(df: DataFrame, amounts: Sequence[str], luxury: Sequence[str], basic: Sequence[str], age: str, size: str, flag: str) -> DataFrame:
    """Per-age and per-member spend, luxury minus basic, luxury/basic, anomaly flag."""
    total = C.row_sum(amounts)
    lux, bas = C.row_sum(luxury), C.row_sum(basic)
    return df.withColumns({
        "spend_per_age": C.safe_ratio(total, F.col(age) + 1.0),
        "spend_per_member": C.safe_ratio(total, F.greatest(F.col(size), F.lit(1))),
        "lux_minus_basic": lux - bas,
        "lux_to_basic": C.safe_ratio(lux, bas + 1.0),
        "flag_spender": (F.coalesce(F.col(flag) == "True", F.lit(False)) & (total > 0)).cast("int"),
    })


def rule_features(df: DataFrame, amounts: Sequence[str], flag: str) -> DataFrame:
    """Raw rule features and flag x amount interactions."""
    known = F.lit(True)
    for a in amounts:
        known = known & F.col(a).isNotNull()
    known_total = C.row_sum(amounts)
    has_pos = F.lit(False)
    for a in amounts:
        has_pos = has_pos | F.coalesce(F.col(a) > 0, F.lit(False))
    flag_true = F.coalesce(F.col(flag) == "True", F.lit(False))
    return df.withColumns({
        "all_known": known.cast("int"),
        "known_total": known_total,
        "has_known_positive": has_pos.cast("int"),
        "strict_zero": (known & (known_total == 0)).cast("int"),
        "flag_conflict": (flag_true & has_pos).cast("int"),
        "missing_amounts": C.row_count_null(amounts),
        "flag_x_zero": (flag_true & (known_total == 0)).cast("int"),
        "flag_x_strict_zero": (flag_true & known & (known_total == 0)).cast("int"),
        "flag_x_spend_count": flag_true.cast("int") * C.row_count_positive(amounts),
    })


# ------------------------------------------------------------------ group transforms (G)


def group_transform(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], null_safe: bool = False) -> DataFrame:
    """Aggregate by ``keys`` and attach the results to every row."""
    stats = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
    return lookup(df, stats, keys, null_safe=null_safe)


def group_median_gap(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """``column`` minus the exact median of its group (positions, not a per-group value map)."""
    from tessera.operators.profile import exact_quantiles

    med = exact_quantiles(df, [column], [0.5], by=list(keys), many_groups=True).select(*keys, F.col("q0").alias("__med"))
    out = lookup(df, med, list(keys))
    return out.withColumn(name, F.col(column) - F.col("__med")).drop("__med")


def percent_rank_avg(df: DataFrame, keys: Sequence[str], column: str, name: str, null_value: float = 0.5) -> DataFrame:
    """Percentile rank with average ties inside each group (pandas ``rank(pct=True)``).

    pct = (values below + (ties + 1) / 2) / non-null count; null value or null
    key -> ``null_value``.  Rows collapse to (group, value, ties) first; the
    running count over each group's values is a range-partitioned running
    sum (:func:`core.running_totals`), so a hot group's distinct values are
    spread over many tasks.  Not ``percent_rank()``, which uses the lowest
    rank and n - 1.
    """
    from tessera.operators.core import running_totals

    nonnull = F.col(column).isNotNull()
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    vals = df.filter(nonnull).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__t"))
    run = running_totals(vals, [column], list(keys), ["__t"], many_groups=bool(keys))
    tot = vals.groupBy(*keys).agg(F.sum("__t").alias("__tot"))
    from tessera.operators.core import attach_row

    ranked = lookup(run, tot, list(keys)) if keys else attach_row(run, tot)
    ranked = ranked.select(*keys, column, ((F.col("cum___t") - F.col("__t") + (F.col("__t") + 1) / 2.0) / F.col("__tot")).alias("__pct"))
    out = lookup(df, ranked, [*keys, column])
    return out.withColumn(name, F.coalesce(F.col("__pct"), F.lit(null_value))).drop("__pct")


def structure_flags(df: DataFrame, size: str, member: str) -> DataFrame:
    """Solo, multi, leader, member ratio, first and last member."""
    return df.withColumns({
        "is_solo": (F.col(size) == 1).cast("int"),
        "is_multi": (F.col(size) > 1).cast("int"),
        "is_leader": (F.col(member) == 1).cast("int"),
        "member_ratio": C.safe_ratio(F.greatest(F.col(member), F.lit(0)), F.greatest(F.col(size), F.lit(1))),
        "is_first": (F.col(member) == 1).cast("int"),
        "is_last": (F.col(member) == F.col(size)).cast("int"),
    })


def rank01(df: DataFrame, score: str, tie: str, name: str = "rank01", by: Sequence[str] = ()) -> DataFrame:
    """Stable rank of ``score`` (ties by ``tie``) scaled to [0, 1] = (pos - 1) / (n - 1).

    Uses :func:`core.ordered_index` (range partitioning + offsets), so no
    window collapses the table into one partition.
    """
    out = ordered_index(df, [score, tie], by=by, name="__pos", count_name="__n")
    return out.withColumn(
        name, F.when(F.col("__n") <= 1, F.lit(0.0)).otherwise((F.col("__pos") - 1) / (F.col("__n") - 1))
    ).drop("__pos", "__n")


def univariate_cv_accuracy(df: DataFrame, variants: Mapping[str, Column], label: str, fold: str) -> DataFrame:
    """Cross-validated accuracy of a one-feature logistic model per transform variant.

    Re-aimed without model fits: the one-feature logistic score is monotone in
    x, and the sign of its slope is the sign of cov(x, y) on the fold's training
    rows (the profile log-likelihood is concave with derivative n cov(x, y) at
    slope 0; an L2 penalty does not change the sign).  The reference then picks
    the accuracy-maximising cutoff on the validation fold itself, so each
    (variant, fold) scores max over t of accuracy(sign * x > t), t over the
    validation values and +inf.  Sums are additive (total - own fold); the
    cutoff search is a running sum over distinct values.
    """
    from tessera.operators.core import running_totals

    y = F.col(label).cast("double")
    long = df.select(y.alias("__y"), F.col(fold).alias("__f"),
                     F.explode(F.array(*[F.struct(F.lit(n).alias("v"), e.cast("double").alias("x")) for n, e in variants.items()])).alias("s"))
    long = long.select("s.v", "s.x", "__y", "__f").filter(F.col("x").isNotNull())
    pf = long.groupBy("v", "__f").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("__y").alias("sy"),
                                     F.sum(F.col("x") * F.col("__y")).alias("sxy"))
    tot = pf.groupBy("v").agg(*[F.sum(c).alias(f"t_{c}") for c in ("n", "sx", "sy", "sxy")])
    d = pf.join(F.broadcast(tot), "v").select(
        "v", "__f",
        F.signum((F.col("t_sxy") - F.col("sxy")) - (F.col("t_sx") - F.col("sx")) * (F.col("t_sy") - F.col("sy"))
                 / (F.col("t_n") - F.col("n"))).alias("d"))
    xs = long.join(F.broadcast(d), ["v", "__f"]).select("v", "__f", (F.col("x") * F.col("d")).alias("xp"), "__y")
    d2 = xs.groupBy("v", "__f", "xp").agg(F.sum("__y").alias("pos"), F.sum(1 - F.col("__y")).alias("neg"))
    c = running_totals(d2, [F.desc("xp")], ["v", "__f"], ["pos", "neg"])
    c = c.withColumns({"tp": F.col("cum_pos") - F.col("pos"), "fp": F.col("cum_neg") - F.col("neg")})
    per = c.groupBy("v", "__f").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                                    F.max(F.col("tp") - F.col("fp")).alias("best_gain"))
    acc = per.select("v", "__f", ((F.greatest(F.col("best_gain"), F.lit(0.0)) + F.col("N")) / (F.col("P") + F.col("N"))).alias("a"))
    out = acc.groupBy(F.col("v").alias("variant")).agg(F.avg("a").alias("cv_accuracy"))
    # the first variant of the greatest accuracy wins (to nine digits: sums of folds have no order), the others are the drop list
    place = F.array_position(F.array(*map(F.lit, variants)), F.col("variant"))
    best = F.row_number().over(Window.orderBy(F.desc(F.round("cv_accuracy", 9)), place))  # a row per variant
    return out.withColumn("winner", best == 1)
