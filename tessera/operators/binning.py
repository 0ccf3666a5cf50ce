"""Binning.

Quantile edges are exact (linear interpolation, as numpy's default) and
computed from global positions, optionally per fold; the bin of a value is
``1 + size(filter(edges, e -> e < x))`` (right-closed bins), a higher-order
function evaluated JVM-side.  ``ml.Bucketizer`` is left-closed and
``QuantileDiscretizer`` approximate, so neither gives the reference's bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.core import explode_folds, lookup, with_scalars


def edge_quantiles(bins: int) -> list[float]:
    """Distinct fractions i / b (b = 2..bins) whose quantiles the edge fit needs."""
    return sorted({i / b for b in range(2, bins + 1) for i in range(1, b)})


def fit_quantile_edges(
    df: DataFrame,
    column: str,
    bins: int = 5,
    fit_on: Column | None = None,
    fold_col: str | None = None,
    k: int | None = None,
    name: str = "edges",
) -> DataFrame:
    """Interior edges of up to ``bins`` quantile bins over the non-null values.

    The bin count is min(bins, distinct values); duplicate edges merge and
    edges equal to the minimum or maximum vanish (outer edges are infinite).
    One row, or one row per ``fit_fold`` (rows outside the fold, copied to
    every fold they train).  Quantiles come from global positions
    (:func:`profile.exact_quantiles`), the distinct count from a two-phase
    distinct aggregate: no single task ever holds all values.
    """
    from tessera.operators.profile import exact_quantiles

    src = df.filter(fit_on) if fit_on is not None else df
    src = src.filter(F.col(column).isNotNull())
    keys: list[str] = []
    if fold_col is not None:
        src = explode_folds(src, fold_col, int(k))
        keys = ["fit_fold"]
    qs = edge_quantiles(bins)
    q = exact_quantiles(src, [column], qs, by=keys).drop("variable", "n")
    st = src.groupBy(*keys).agg(
        F.count_distinct(column).alias("__nd"), F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    # st has one row (per fold) even when there is no value; quantile rows may be missing then
    if keys:
        j = st.join(q, keys, "left")
    else:
        j = st.withColumn("__one", F.lit(1)).join(F.broadcast(q.withColumn("__one", F.lit(1))), "__one", "left")
    return j.select(*keys, edges_expr({v: F.col(f"q{i}") for i, v in enumerate(qs)}, bins).alias(name))


def edges_expr(quantile_at: dict[float, Column], bins: int = 5) -> Column:
    """Edges from the quantile columns (keyed by fraction) and ``__nd``/``__lo``/``__hi`` columns.

    min(bins, distinct values) bins; interior edges only, sorted, duplicates merged.
    """
    def at(b):
        return F.array(*[quantile_at[i / b] for i in range(1, b)])

    chosen = F.when(F.col("__nd") <= 1, F.array().cast("array<double>"))
    for b in range(2, bins):
        chosen = chosen.when(F.col("__nd") == b, at(b))
    chosen = chosen.otherwise(at(bins))
    inner = F.filter(chosen, lambda e: (e > F.col("__lo")) & (e < F.col("__hi")))
    return F.array_sort(F.array_distinct(inner))


def apply_quantile_bins(
    df: DataFrame,
    column: str,
    edges: DataFrame | None,
    name: str,
    label_prefix: str = "Bin_",
    missing_label: str | None = "Bin_Missing",
    fold_col: str | None = None,
    k: int | None = None,
) -> DataFrame:
    """Label ``prefix<i>`` for the right-closed bin i of ``column``; null -> ``missing_label``."""
    if edges is None:  # an ``edges`` column is already attached
        out = df
    elif fold_col is not None:
        out = lookup(df.withColumn("fit_fold", F.col(fold_col)), edges, ["fit_fold"], bound=k).drop("fit_fold")
    else:
        out = with_scalars(df, edges)
    x = F.col(column)
    idx = F.size(F.filter(F.col("edges"), lambda e: e < x)) + 1
    label = F.concat(F.lit(label_prefix), idx.cast("string"))
    out = out.withColumn(name, F.when(x.isNull(), F.lit(missing_label)).otherwise(label))
    return out.drop("edges")


def fixed_bins(c: Column, edges: Sequence[float], labels: Sequence[str], right: bool, unknown: str = "Unknown") -> Column:
    """Fixed edges; ``right`` = right-closed (a, b], else left-closed [a, b).

    ``edges`` are the outer and inner edges (len(labels) + 1 values, may be
    +-inf).  Outside values and null give ``unknown``.
    """
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = ((c > lo) & (c <= hi)) if right else ((c >= lo) & (c < hi))
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return F.coalesce(out, F.lit(unknown))


def count_bucket(c: Column) -> Column:
    """Count buckets Freq_0, Freq_1, Freq_2, Freq_3_4, Freq_5_7, Freq_8_plus (fixed values)."""
    return (
        F.when(c.isNull() | (c <= 0), "Freq_0")
        .when(c == 1, "Freq_1")
        .when(c == 2, "Freq_2")
        .when(c <= 4, "Freq_3_4")
        .when(c <= 7, "Freq_5_7")
        .otherwise("Freq_8_plus")
    )
