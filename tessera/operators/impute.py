"""Missing data: indicators, rule fills and train-fit imputation.

Fitted statistics are DataFrames keyed by their level columns (and by
``fit_fold`` when fitted per fold), joined back with :func:`core.lookup`.
Group-level fills are an aggregate (map-side combined, so a hot group
collapses before the shuffle) followed by a join that AQE can broadcast or
split when skewed — not a window, which would put a hot group in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators.core import explode_folds, lookup, settled, with_scalars


def missing_indicators(df: DataFrame, columns: Sequence[str], suffix: str = "Missing") -> DataFrame:
    """``<c>Missing`` = 1 where ``c`` is null, taken before any fill."""
    return df.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("int") for c in columns})


def missing_count(df: DataFrame, columns: Sequence[str], name: str = "missing_count") -> DataFrame:
    """Number of null columns in the row."""
    return df.withColumn(name, C.row_count_null(columns))


def group_consistent_fill(
    df: DataFrame, group: str | Sequence[str], columns: Sequence[str], fit_on: Column | None = None, sizes: Mapping[str, str] | None = None
) -> DataFrame:
    """Fill a null from its group when the group has exactly one distinct value.

    ``fit_on`` restricts the rows that define the group values (train-fit
    variant); the fill applies to every row.  Adds ``<c>_group_filled`` 0/1.

    ``sizes`` maps one of the group keys to a column: the number of rows with that key in the whole of
    ``df`` (null for a null key), added up from the groups' own counts, so that it needs no other shuffle of the rows.
    """
    if sizes and fit_on is not None:
        raise ValueError("sizes count all rows, fit_on leaves rows out")
    keys = [group] if isinstance(group, str) else list(group)
    src = df.filter(fit_on) if fit_on is not None else df
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"__min_{c}"), F.max(c).alias(f"__max_{c}")]
    sizes = dict(sizes or {})
    if sizes:
        aggs.append(F.count(F.lit(1)).alias("__rows"))
    stats = src.groupBy(*keys).agg(*aggs)
    for key, name in sizes.items():
        stats = lookup(stats, stats.groupBy(key).agg(F.sum("__rows").alias(name)), [key])
    stats = stats.select(
        *keys, *sizes.values(),
        *[F.when(F.col(f"__min_{c}") == F.col(f"__max_{c}"), F.col(f"__min_{c}")).alias(f"__fill_{c}") for c in columns],
    )
    out = lookup(df, stats, keys, null_safe=True)
    out = out.withColumns(
        {f"{c}_group_filled": (F.col(c).isNull() & F.col(f"__fill_{c}").isNotNull()).cast("int") for c in columns}
    )
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__fill_{c}")) for c in columns})
    return out.drop(*[f"__fill_{c}" for c in columns])


def mode_table(df: DataFrame, keys: Sequence[str], column: str, name: str = "mode") -> DataFrame:
    """Most frequent non-null value per key, ties to the lowest value.

    Two aggregates: counts per (key, value), then the best (count desc,
    value asc) per key -- no per-group value map in one task.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min_by(F.col(column), F.struct((-F.col("__n")).alias("a"), F.col(column).alias("b")))
    return counts.groupBy(*keys).agg(best.alias(name))


def _scalar(one_row: DataFrame):
    """The single fitted value of a keyless statistic (None when there was no value)."""
    row = one_row.first()
    return None if row is None else row[-1]


def _median_table(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact median per key from global positions (null key is a key)."""
    from tessera.operators.profile import exact_quantiles

    q = exact_quantiles(df, [column], [0.5], by=list(keys), many_groups=bool(keys))
    return q.select(*keys, F.col("q0").alias(name))


def cascade_mode_fill(
    df: DataFrame, column: str, key_chain: Sequence[str], fit_on: Column | None = None, final_global: bool = True
) -> DataFrame:
    """Fill by the mode of key 1, then key 2, ..., then the global mode.

    Each level is one aggregate + one join and sees the fills of the levels
    before it; a null key value is not a group (it gets no fill from it).
    Ties go to the lowest value.  The global mode is one scalar.
    """
    out = df
    for i, key in enumerate(key_chain):
        src = out.filter(fit_on) if fit_on is not None else out
        stats = mode_table(src.filter(F.col(key).isNotNull()), [key], column, f"__mode{i}")
        out = lookup(out, stats, [key])
        out = out.withColumn(column, F.coalesce(F.col(column), F.col(f"__mode{i}"))).drop(f"__mode{i}")
    if final_global:
        src = out.filter(fit_on) if fit_on is not None else out
        g = _scalar(mode_table(src, [], column, "__g"))
        out = out.withColumn(column, F.coalesce(F.col(column), F.lit(g)))
    return out


def cascade_median_fill(
    df: DataFrame, column: str, key_chain: Sequence[str], fit_on: Column | None = None
) -> DataFrame:
    """Median by key 1, fill; median by key 2 on the filled values, fill; ...; global.

    Each step sees the earlier fills, as in the reference; null key values
    form no group.
    """
    out = df
    for i, key in enumerate(key_chain):
        src = out.filter(fit_on) if fit_on is not None else out
        stats = _median_table(src.filter(F.col(key).isNotNull()), [key], column, f"__med{i}")
        out = lookup(out, stats, [key])
        out = out.withColumn(column, F.coalesce(F.col(column), F.col(f"__med{i}"))).drop(f"__med{i}")
    src = out.filter(fit_on) if fit_on is not None else out
    g = _scalar(_median_table(src, [], column, "g"))
    return out.withColumn(column, F.coalesce(F.col(column), F.lit(g)))


def first_seen_fill(df: DataFrame, key: str, column: str, order: str) -> DataFrame:
    """Null filled by the first non-null value of the key in ``order``."""
    guide = (
        df.filter(F.col(column).isNotNull() & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min_by(column, order).alias("__first"))
    )
    out = lookup(df, guide, [key])
    return out.withColumn(column, F.coalesce(F.col(column), F.col("__first"))).drop("__first")


def infer_flag(df: DataFrame, flag: str, amounts: Sequence[str], age: str, adult: float = 18.0) -> DataFrame:
    """Null flag -> "False" if any amount > 0; -> "True" if adult, all amounts known, sum 0.

    Adds ``flag_rule`` with the rule that fired ("positive_to_false",
    "adult_zero_to_true") for the fill counts.
    """
    any_pos = F.lit(False)
    for a in amounts:
        any_pos = any_pos | F.coalesce(F.col(a) > 0, F.lit(False))
    all_known = F.lit(True)
    for a in amounts:
        all_known = all_known & F.col(a).isNotNull()
    zero_sum = C.row_sum(amounts) == 0
    is_null = F.col(flag).isNull()
    rule = (
        F.when(is_null & any_pos, "positive_to_false")
        .when(is_null & F.col(age).isNotNull() & (F.col(age) >= adult) & all_known & zero_sum, "adult_zero_to_true")
    )
    out = df.withColumn("flag_rule", rule)
    return out.withColumn(
        flag,
        F.when(F.col("flag_rule") == "positive_to_false", "False")
        .when(F.col("flag_rule") == "adult_zero_to_true", "True")
        .otherwise(F.col(flag)),
    )


def infer_flag_loose(df: DataFrame, flag: str, amounts: Sequence[str], overwrite: bool = False) -> DataFrame:
    """Null flag -> True if total == 0 else False; ``overwrite`` replaces every flag, and null amounts are 0 from then on."""
    total = C.row_sum(amounts)
    derived = F.when(total == 0, "True").otherwise("False")
    if overwrite:
        return df.withColumns({flag: derived, **{a: F.coalesce(F.col(a), F.lit(0.0)) for a in amounts}})
    return df.withColumn(flag, F.coalesce(F.col(flag), derived))


def enforce_flag_zero(df: DataFrame, flag: str, amounts: Sequence[str]) -> DataFrame:
    """flag == "True" forces every amount to 0."""
    on = F.coalesce(F.col(flag) == "True", F.lit(False))
    return df.withColumns({a: F.when(on, F.lit(0.0)).otherwise(F.col(a)) for a in amounts})


def range_guard(df: DataFrame, column: str, lo: float = 0.0, hi: float = 100.0, flag: str | None = None) -> DataFrame:
    """Values outside [lo, hi] become null; ``flag`` marks them 0/1."""
    out_of_range = (F.col(column) < lo) | (F.col(column) > hi)
    if flag:
        df = df.withColumn(flag, F.coalesce(out_of_range, F.lit(False)).cast("int"))
    return df.withColumn(column, F.when(out_of_range, F.lit(None).cast("double")).otherwise(F.col(column)))


# ------------------------------------------------------------ hierarchical medians

@dataclass
class SpendStats:
    """Fitted statistics of :func:`fit_hier_medians` (all DataFrames, keyed by fit_fold if folded)."""

    amounts: list[str]
    levels: list[list[str]]
    level_tables: list[DataFrame]
    global_table: DataFrame | None
    fold_key: str | None
    bounds: list[int]  # rows of each level's table at most


def global_values(amounts: Sequence[str]) -> list:
    """The amounts and, named ``pos_<a>``, the positive ones of each, for :func:`profile.level_quantiles`."""
    return [*amounts, *[(f"pos_{a}", F.col(a), lambda x: x > 0) for a in amounts]]


def _global_finals(amounts: Sequence[str]) -> list[Column]:
    """gmed = median (0 if none); pmed = median of the positive values (else the median, else 0)."""
    return [F.coalesce(F.col(a), F.lit(0.0)).alias(f"gmed_{a}") for a in amounts] + [
        F.coalesce(F.col(f"pos_{a}"), F.col(a), F.lit(0.0)).alias(f"pmed_{a}") for a in amounts
    ]


def fit_hier_medians(
    df: DataFrame,
    amounts: Sequence[str],
    levels: Sequence[Sequence[str]],
    fit_on: Column | None = None,
    fold_col: str | None = None,
    k: int | None = None,
    with_global: bool = True,
) -> SpendStats:
    """Medians of every amount at every key level, plus global and positive-only medians.

    A null key value is a level of its own.  All levels and the global medians are one
    pass (:func:`profile.level_quantiles`, exact medians without a per-group value map
    in one task), pivoted back to one column per amount.  With
    ``fold_col``/``k`` the statistics are fitted for every fold at once on the
    rows outside that fold (rows copied k-1 times, which exact medians need;
    additive statistics elsewhere avoid the copies).
    """
    from tessera.operators.profile import level_quantiles

    src = df.filter(fit_on) if fit_on is not None else df
    fkey: list[str] = []
    if fold_col is not None:
        src = explode_folds(src, fold_col, int(k))
        fkey = ["fit_fold"]
    asked = [(lvl, list(amounts)) for lvl in levels] + ([([], global_values(amounts))] if with_global else [])
    found = settled(lambda: level_quantiles(src, asked, [0.5], by=fkey), "medians")
    return spend_stats(src, found, amounts, levels, fkey, with_global)


def spend_stats(
    src: DataFrame, found: DataFrame, amounts: Sequence[str], levels: Sequence[Sequence[str]], fkey: Sequence[str], with_global: bool = True
) -> SpendStats:
    """The statistics of D12 from written ``level_quantiles`` rows (``q0`` the median), global values in the level after the last."""
    from tessera.operators.profile import level_table

    tables = [level_table(found, i, lvl, {a: f"med{i}_{a}" for a in amounts}, by=fkey) for i, lvl in enumerate(levels)]
    glob = None
    if with_global:
        names = {n: n for n in [*amounts, *[f"pos_{a}" for a in amounts]]}
        wide = level_table(found, len(levels), [], names, by=fkey)
        if fkey:  # a fold without any value has no quantiles
            wide = src.select(*fkey).distinct().join(wide, list(fkey), "left")
        glob = wide.select(*fkey, *_global_finals(amounts))
    # counted, so that the rows aren't shuffled to meet a few groups
    rows = {r["level"]: r["n"] for r in found.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = [rows.get(i, 0) for i in range(len(levels))]
    return SpendStats(list(amounts), [list(lv) for lv in levels], tables, glob, fkey[0] if fkey else None, bounds)


def apply_hier_medians(
    df: DataFrame, stats: SpendStats, flag: str, fold_col: str | None = None, k: int | None = None
) -> DataFrame:
    """Fill each amount: 0 if flag, else first level with a median, else the
    positive-only median if another *original* amount is > 0, else the global median.

    Adds ``<a>_fill`` = zero | observed | level1.. | positive | global.  Three
    joins in total (one per level) whatever the number of amounts.
    """
    fkey = []
    out = df
    if stats.fold_key:
        out = out.withColumn("fit_fold", F.col(fold_col))
        fkey = ["fit_fold"]
    for lvl, tab, bound in zip(stats.levels, stats.level_tables, stats.bounds):
        out = lookup(out, tab, [*fkey, *lvl], null_safe=True, bound=bound)
    if stats.global_table is not None:  # else gmed_/pmed_ columns are already attached
        out = lookup(out, stats.global_table, fkey, bound=k) if fkey else with_scalars(out, stats.global_table)
    flag_true = F.coalesce(F.col(flag) == "True", F.lit(False))
    new_cols = {}
    for a in stats.amounts:
        others = F.lit(False)
        for b in stats.amounts:
            if b != a:
                others = others | F.coalesce(F.col(b) > 0, F.lit(False))
        v = F.when(flag_true, F.lit(0.0)).when(F.col(a).isNotNull(), F.col(a))
        kind = F.when(flag_true, "zero").when(F.col(a).isNotNull(), "observed")
        for i in range(len(stats.levels)):
            m = F.col(f"med{i}_{a}")
            v = v.when(m.isNotNull(), m)
            kind = kind.when(m.isNotNull(), f"level{i + 1}")
        v = v.when(others, F.col(f"pmed_{a}")).otherwise(F.col(f"gmed_{a}"))
        kind = kind.when(others, "positive").otherwise("global")
        new_cols[a] = v
        new_cols[f"{a}_fill"] = kind
    out = out.withColumns(new_cols)
    drop = [f"med{i}_{a}" for i in range(len(stats.levels)) for a in stats.amounts]
    drop += [f"gmed_{a}" for a in stats.amounts] + [f"pmed_{a}" for a in stats.amounts] + fkey
    return out.drop(*drop)


def simple_impute(
    df: DataFrame, columns: Sequence[str], strategy: str = "median", fit_on: Column | None = None
) -> DataFrame:
    """Mean / median / most_frequent, fitted on ``fit_on`` rows (one aggregate)."""
    src = df.filter(fit_on) if fit_on is not None else df
    if strategy == "mean":
        row = src.agg(*[F.avg(c).alias(c) for c in columns]).first()
        vals = {c: row[c] for c in columns}
    elif strategy == "median":
        vals = {c: _scalar(_median_table(src, [], c, "m")) for c in columns}
    else:
        vals = {c: _scalar(mode_table(src, [], c, "m")) for c in columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(vals[c])) for c in columns})


def post_fill(df: DataFrame, strings: Sequence[str] = (), numerics: Sequence[str] = (), unknown: str = "Unknown") -> DataFrame:
    """Strings -> "Unknown", numerics -> 0, +/-inf and NaN -> 0."""
    cols = {s: F.coalesce(F.col(s), F.lit(unknown)) for s in strings}
    for n in numerics:
        x = F.col(n).cast("double")
        cols[n] = F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)
    return df.withColumns(cols)
