"""Profile aggregates: distinct and null counts, quantiles, histograms, box statistics,
cross-tabs, top-N, zero shares, frequency-of-frequency (SURVEY §2.F7-F23, §2.P).

Every statistic over many columns is one aggregate (one job): the columns
are aggregated side by side, then unpivoted into long report rows.  The
results are bounded by the number of columns x bins, never by the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.core import attach_row, lookup, materialize, ordered_index, running_totals


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F8: (column, nulls, rate) for every column, one aggregate."""
    n = F.count(F.lit(1)).alias("__n")
    wide = df.agg(n, *[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in columns])
    long = wide.unpivot(["__n"], list(columns), "column_name", "nulls")
    return long.select("column_name", F.col("nulls").cast("bigint").alias("nulls"), (F.col("nulls") / F.col("__n")).alias("rate"))


def distinct_counts(df: DataFrame, columns: Sequence[str], by: str | None = None, exact: bool = True) -> DataFrame:
    """distinct non-null values per column (per ``by`` value, e.g. split), long form.

    ``exact=False`` switches to HyperLogLog (``approx_count_distinct``), whose
    state is a fixed-size sketch per group, for very large tables.
    """
    fn = F.count_distinct if exact else F.approx_count_distinct
    keys = [by] if by else []
    wide = df.groupBy(*keys).agg(*[fn(c).alias(c) for c in columns])
    return wide.unpivot(keys, list(columns), "column_name", "n_distinct")


def quantiles(df: DataFrame, column: str, qs: Sequence[float], by: Sequence[str] = (), accuracy: int | None = None) -> DataFrame:
    """exact linear-interpolated quantiles from global positions, or ``approx_percentile`` with ``accuracy``."""
    names = [f"q{int(round(q * 100)):02d}" for q in qs]
    if accuracy is not None:
        arr = F.array(*[F.lit(q) for q in qs])
        out = df.groupBy(*by).agg(F.percentile_approx(column, arr, accuracy).alias("__q"))
        return out.select(*by, *[F.get("__q", i).alias(n) for i, n in enumerate(names)])
    q = exact_quantiles(df, [column], qs, by=list(by), many_groups=bool(by))
    return q.select(*by, *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])


def lower_quantile(df: DataFrame, column: str, q: float, by: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """the order statistic at index floor(q * (n - 1)) (numpy ``method="lower"``).

    Not ``percentile_disc`` (different index rule).  Positions come from
    :func:`core.ordered_index`, so no single-partition window is needed.
    """
    order = [column] + ([tie] if tie else [])
    src = df.filter(F.col(column).isNotNull())
    idx = ordered_index(src, order, by=by, name="__rn", count_name="__n")
    pick = idx.filter(F.col("__rn") == F.floor(F.lit(q) * (F.col("__n") - 1)) + 1)
    return pick.select(*by, F.lit(q).alias("q"), F.col(column).alias("value"))


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """``bins`` equal-width bins over the observed [min, max] (max in the last bin).

    Two aggregates: range, then counts per bin index; bounded output.  The ranges are
    counted before they are joined, so that the rows of few groups stay where they are.
    """
    x = F.col(column)
    rng = df.groupBy(*by).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    # a null key is a key
    j = _lookup_counted(df.filter(x.isNotNull()), rng, by, "ranges") if by else attach_row(df.filter(x.isNotNull()), rng)
    width = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("__lo")) / width), F.lit(bins - 1))
    ).cast("int")
    out = j.groupBy(*by, b.alias("bin"), "__lo", "__hi").agg(F.count(F.lit(1)).alias("n"))
    return out.select(
        *by, "bin",
        (F.col("__lo") + F.col("bin") * (F.col("__hi") - F.col("__lo")) / bins).alias("left"),
        (F.col("__lo") + (F.col("bin") + 1) * (F.col("__hi") - F.col("__lo")) / bins).alias("right"),
        "n",
    )


def _lookup_counted(df: DataFrame, stats: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Join written ``stats`` (a row per group) onto the rows, broadcast if they are counted to be few.

    A shuffle by a few keys, as column names, would take all rows of a key to one task.
    """
    stats = materialize(stats, name)
    return lookup(df, stats, list(by), null_safe=True, bound=stats.count())


def box_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """quartiles, 1.5 IQR whiskers (furthest data inside the fences), outlier count.

    Two aggregates and a join of the per-key fences (null key = a key), which are counted before.
    """
    x = F.col(column)
    q = exact_quantiles(df, [column], [0.25, 0.5, 0.75], by=list(by), many_groups=bool(by))
    q = q.select(*by, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = materialize(q, "quartiles")  # counted, and read by the fences and the result
    fences = q.select(*by, (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("__lo"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("__hi"))
    src = df.filter(x.isNotNull())
    j = lookup(src, fences, list(by), null_safe=True, bound=fences.count()) if by else attach_row(src, fences)
    inside = (x >= F.col("__lo")) & (x <= F.col("__hi"))
    wh = j.groupBy(*by).agg(
        F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("outliers"),
    )
    return lookup(q, wh, list(by), null_safe=True) if by else attach_row(q, wh)


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str], missing: str = "Missing") -> DataFrame:
    """counts of ``row`` x ``col`` (null as ``missing``) plus row-normalised shares."""
    r = F.coalesce(F.col(row).cast("string"), F.lit(missing)).alias(row)
    c = F.coalesce(F.col(col).cast("string"), F.lit(missing))
    t = df.select(r, c.alias("__c")).groupBy(row).pivot("__c", list(values)).agg(F.count(F.lit(1)))
    t = t.fillna(0, subset=list(values))
    total = None
    for v in values:
        total = F.col(v) if total is None else total + F.col(v)
    return t.select(
        row, *[F.col(v).cast("bigint").alias(f"n_{v}") for v in values],
        *[(F.col(v) / total).alias(f"share_{v}") for v in values],
    )


def top_other(df: DataFrame, column: str, n: int, other: str = "Other") -> DataFrame:
    """the ``n`` most frequent values (ties by value), the rest summed as ``other``.

    The top values come from a take-ordered limit (per-partition top n, then
    a merge of n rows per partition), so the n kept values are bounded by the
    parameter and broadcast back; no window over all distinct values.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc_nulls_first(column)).limit(n).select(column, F.lit(True).alias("__top"))
    ranked = lookup(counts, top, [column], null_safe=True, bound=n)
    label = F.when(F.col("__top"), F.coalesce(F.col(column).cast("string"), F.lit("Missing"))).otherwise(F.lit(other))
    return ranked.groupBy(label.alias("value")).agg(F.sum("n").alias("n"))


def zero_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """share of zeros among the non-null values, per column."""
    wide = df.agg(*[F.avg(F.when(F.col(c).isNotNull(), (F.col(c) == 0).cast("double"))).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "zero_share")


def freq_of_freq(df: DataFrame, column: str) -> DataFrame:
    """how many values occur 1, 2, 3-5, 6-10, >10 times (two aggregates)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    bucket = (
        F.when(F.col("n") == 1, "1").when(F.col("n") == 2, "2").when(F.col("n") <= 5, "3-5")
        .when(F.col("n") <= 10, "6-10").otherwise(">10")
    )
    return counts.groupBy(bucket.alias("times")).agg(F.count(F.lit(1)).alias("values"))


def value_buckets(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    """valid / out_of_range / missing counts and the missing share."""
    x = F.col(column)
    return df.agg(
        F.sum(x.between(lo, hi).cast("bigint")).alias("valid"),
        F.sum(((x < lo) | (x > hi)).cast("bigint")).alias("out_of_range"),
        F.sum(x.isNull().cast("bigint")).alias("missing"),
        F.avg(x.isNull().cast("double")).alias("missing_share"),
    )


def category_counts(df: DataFrame, column: str, missing: str = "Missing") -> DataFrame:
    """Counts per value with null as its own class."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def schema_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    """Per column of two frames: type, missing and distinct counts of each; shared, train-only or test-only.

    The counts are one row per column from an unpivot and two-level aggregates, so no column's values meet in one task.
    """
    tr, te = dict(train.dtypes), dict(test.dtypes)
    names = list(dict.fromkeys([*tr, *te]))
    rows = [(c, tr.get(c), te.get(c), c in tr and c in te, c in tr and c not in te, c in te and c not in tr) for c in names]
    out = train.sparkSession.createDataFrame(
        rows, "column_name string, train_type string, test_type string, shared boolean, train_only boolean, test_only boolean"
    )
    for name, df in (("train", train), ("test", test)):
        long = df.select([F.col(c).cast("string").alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "v")
        values = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
        counts = values.groupBy("column_name").agg(
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias(f"{name}_missing"), F.count("v").alias(f"{name}_unique"))
        out = out.join(counts, "column_name", "left")
    return out


def sum_column(cs: Sequence[Column]) -> Column:
    out = cs[0]
    for c in cs[1:]:
        out = out + c
    return out


def exact_quantiles(
    df: DataFrame, values: Sequence[str | tuple[str, Column]], qs: Sequence[float], by: Sequence[str] = (),
    many_groups: bool = False,
) -> DataFrame:
    """Exact linear-interpolation quantiles, by one plan for every size.

    ``values`` are column names or (name, expression) pairs, unpivoted into one
    long table.  Rows first collapse to counts per (by, variable, value), so a
    value that many rows share is one row; running counts over the values
    (range partitioned, :func:`core.running_totals`) then say which value
    stands at a position, and no task holds a group.  For n non-null values
    and quantile q, with h = (n - 1) q: x[floor h] + (h - floor h) (x[ceil h] -
    x[floor h]), as numpy's default and DuckDB's ``quantile_cont``.  Returns one
    row per (by, variable) with columns ``q0, q1, ...`` in the order of ``qs``.  A
    null group key is a group; nulls in the values are ignored.
    """
    keys = [*by, "__var"]
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(n).alias("__var"), e.cast("double").alias("__x")) for n, e in _named(values)
    ])).alias("__s")).select(*by, "__s.__var", "__s.__x").filter(F.col("__x").isNotNull())
    counts = long.groupBy(*keys, "__x").agg(F.count(F.lit(1)).alias("__t"))
    return _quantiles_of_counts(counts, keys, qs, many_groups).withColumnRenamed("__var", "variable")


def _named(values: Sequence[str | tuple]) -> list[tuple]:
    return [(v, F.col(v)) if isinstance(v, str) else v for v in values]


def _quantiles_of_counts(counts: DataFrame, keys: Sequence[str], qs: Sequence[float], many_groups: bool, weights: Sequence[str] = ("__t",)) -> DataFrame:
    """``keys, n, q0, q1, ...`` from counts ``__t`` per (keys, value ``__x``).

    With other ``weights`` there are several counts of each value, and a row ``keys, part, n, q0, ...`` for each of them (``part`` from 0) that has any.
    """
    # range partitioning samples its input: written once, it isn't computed twice
    run = running_totals(materialize(counts, "counts"), ["__x"], list(keys), list(weights), many_groups=many_groups, total_prefix="__all")
    parts = []
    aggs = []
    for w in weights:
        own, outs = [F.first(f"__all{w}").alias(f"__n{w}")], []
        for i, q in enumerate(qs):
            h, n = (F.col(f"__all{w}") - 1) * F.lit(float(q)), (F.col(f"__n{w}") - 1) * F.lit(float(q))

            def at(position: Column, w=w) -> Column:
                here = (F.col(f"cum_{w}") - F.col(w) < position) & (position <= F.col(f"cum_{w}"))
                return F.max(F.when(here, F.col("__x")))

            own += [at(F.floor(h) + 1).alias(f"__lo{w}{i}"), at(F.ceil(h) + 1).alias(f"__hi{w}{i}")]
            outs.append((F.col(f"__lo{w}{i}") + (n - F.floor(n)) * (F.col(f"__hi{w}{i}") - F.col(f"__lo{w}{i}"))).alias(f"q{i}"))
        aggs += own
        parts.append(F.struct(F.lit(len(parts)).alias("part"), F.col(f"__n{w}").alias("n"), *outs))
    found = run.groupBy(*keys).agg(*aggs)
    if list(weights) == ["__t"]:
        return found.select(*keys, parts[0].alias("__p")).select(*keys, "__p.*").drop("part")
    return found.select(*keys, F.explode(F.array(*parts)).alias("__p")).select(*keys, "__p.*").where("n > 0")


def level_quantiles(
    df: DataFrame, levels: Sequence[tuple[Sequence[str], Sequence[str | tuple]]], qs: Sequence[float], by: Sequence[str] = (),
    parts: Sequence[Column] = (), part: str = "part",
) -> DataFrame:
    """:func:`exact_quantiles` of several groupings at once: one count, one pass over the positions.

    A variable's values are counted once, by all keys that any of its levels has, and the levels add up these counts.  Each
    variable is a scan of its own columns, so a task's counts are of one variable: ``df`` should be written.

    ``levels`` are (group keys, values) pairs, the keys none for a global quantile; a value may also be (name, expression, rule): of the
    expression's values those for which ``rule(value)`` holds, taken from the same counts.  Returns a row per group with
    ``level`` (its place in ``levels``, from 0), ``by``, every key of any level (null where the level has it not),
    ``variable``, ``n`` and ``q0, q1, ...``.

    ``parts`` are conditions that name parts of the rows, which may overlap (the train parts of folds): every group gets a row for
    each part, its number in the column ``part``.  A value has one row with a count for each part, so no row is copied to its parts.
    """
    weights = [f"__t{i}" for i in range(len(parts))] or ["__t"]
    ones = [F.coalesce(c.cast("int"), F.lit(0)).alias(w) for c, w in zip(parts, weights)]
    names = list(dict.fromkeys(k for keys, _ in levels for k in keys))
    kinds = dict(df.dtypes)
    asked: dict[str, tuple[Column, list[tuple[int, str, Callable[[Column], Column] | None]]]] = {}
    for i, (_, values) in enumerate(levels):
        for n, e, *rule in _named(values):
            asked.setdefault(str(e), (e, []))[1].append((i, n, rule[0] if rule else None))
    long, at = None, None
    for v, (e, places) in enumerate(asked.values()):
        used = {k for i, _, _ in places for k in levels[i][0]}
        own = [(F.col(k) if k in used else F.lit(None).cast(kinds[k])).alias(k) for k in names]
        scan = df.select(*by, *own, F.lit(v).alias("__v"), e.cast("double").alias("__x"), *ones).filter(F.col("__x").isNotNull())
        long = scan if long is None else long.unionByName(scan)
        structs = []
        for i, n, rule in places:
            one = F.struct(F.lit(i).alias("level"), *[(F.col(k) if k in levels[i][0] else F.lit(None).cast(kinds[k])).alias(k) for k in names], F.lit(n).alias("variable"))
            structs.append(one if rule is None else F.when(rule(F.col("__x")), one))
        at = F.when(F.col("__v") == v, F.array(*structs)) if at is None else at.when(F.col("__v") == v, F.array(*structs))
    sums = [F.sum(w).alias(w) for w in weights]
    cells = long.groupBy(*by, *names, "__v", "__x").agg(*(sums if parts else [F.count(F.lit(1)).alias("__t")]))
    keys = [*by, "level", *names, "variable"]
    counts = cells.select(*by, F.explode(at).alias("__s"), "__x", *weights).where("__s is not null").select(*by, "__s.*", "__x", *weights)
    found = _quantiles_of_counts(counts.groupBy(*keys, "__x").agg(*sums), keys, qs, many_groups=True, weights=weights)
    return found.withColumnRenamed("part", part) if parts else found


def level_table(found: DataFrame, level: int, keys: Sequence[str], columns: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """One level of written :func:`level_quantiles` rows, a column for each variable: ``columns`` maps variable -> name (of its ``q0``)."""
    wide = [F.max(F.when(F.col("variable") == v, F.col("q0"))).alias(n) for v, n in columns.items()]
    return found.where(F.col("level") == level).groupBy(*by, *keys).agg(*wide)
