"""Folds and leakage control.

Two modes for every assignment:

* exact: positions in an md5 order inside each stratum, ``fold = pos % k``;
  the md5 text is the same in DuckDB, so folds are oracle-comparable.
  Positions come from :func:`core.ordered_index` (range partitioning plus
  offsets), so a stratum holding a third of the rows is still spread over
  many tasks.
* bulk: ``pmod(hash(id, seed), k)`` -- a projection, no shuffle at all.

Fold-local statistics carry ``fit_fold`` as a key: additive ones are
``total - own fold``; holistic ones (medians, quantile edges) copy each row
to the k-1 folds it trains (:func:`core.explode_folds`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators.core import lookup, materialize, ordered_index


def kfold(df: DataFrame, id_col: str, k: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """K3 (bulk): plain k-fold by hash, no shuffle."""
    return df.withColumn(name, C.hash_bucket(k, id_col, seed=seed))


def stratified_kfold(df: DataFrame, id_col: str, label: str, k: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """K1 (exact): inside each label, rows in md5(id, seed) order are dealt to folds round-robin."""
    keyed = df.withColumn("__h", C.md5_key(id_col, seed=seed))
    out = ordered_index(keyed, ["__h", id_col], by=[label], name="__pos")
    return out.withColumn(name, ((F.col("__pos") - 1) % k).cast("int")).drop("__h", "__pos")


def stratified_group_kfold(
    df: DataFrame, group: str, label: str, k: int, seed: int = 0, name: str = "fold"
) -> DataFrame:
    """K2: a group never spans folds; groups with the same (size, positives) profile are dealt round-robin.

    One aggregate to the group table, positions inside each profile, a join
    back on the group key.
    """
    groups = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(F.coalesce(F.col(label).cast("int"), F.lit(0))).alias("__pos_y")
    )
    groups = groups.withColumn("__h", C.md5_key(group, seed=seed))
    ranked = ordered_index(groups, ["__h", group], by=["__n", "__pos_y"], name="__r")
    folds = ranked.select(group, ((F.col("__r") - 1) % k).cast("int").alias(name))
    return lookup(df, folds, [group])


def stratified_holdout(
    df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 0, name: str = "holdout"
) -> DataFrame:
    """K5: per label, the first ceil(share * n) rows in md5 order are the holdout (exact counts)."""
    keyed = df.withColumn("__h", C.md5_key(id_col, seed=seed))
    out = ordered_index(keyed, ["__h", id_col], by=[label], name="__pos", count_name="__cnt")
    return out.withColumn(
        name, F.when(F.col("__pos") <= F.ceil(F.lit(test_share) * F.col("__cnt")), "valid").otherwise("train")
    ).drop("__h", "__pos", "__cnt")


def fold_health(df: DataFrame, fold: str, label: str, group: str | None = None) -> DataFrame:
    """K4: rows, positive rate and (if ``group``) the groups shared with another fold, per fold."""
    base = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("pos_rate"))
    if group is None:
        return base
    gf = df.select(group, fold).distinct()
    spread = gf.groupBy(group).agg(F.count(F.lit(1)).alias("__nf"))
    shared = gf.join(spread.filter(F.col("__nf") > 1), group).groupBy(fold).agg(F.count(F.lit(1)).alias("groups_shared"))
    out = base.join(shared, fold, "left")
    return out.withColumn("groups_shared", F.coalesce(F.col("groups_shared"), F.lit(0)).cast("bigint"))


def assert_no_leak(feature_names: Sequence[str], forbidden: Sequence[str]) -> None:
    """K8: audit / id / label columns must never reach a model input."""
    bad = sorted(set(feature_names) & set(forbidden))
    if bad:
        raise ValueError(f"model input carries forbidden columns: {bad}")


def fold_frame(df: DataFrame, fold: str, k: int) -> DataFrame:
    """K6: one row per (row, fit_fold) with role train/valid: every fold's split in one frame."""
    folds = F.array(*[F.lit(i) for i in range(k)])
    out = df.withColumn("fit_fold", F.explode(folds))
    return out.withColumn("role", F.when(F.col(fold) == F.col("fit_fold"), "valid").otherwise("train"))


def fold_additive_stats(
    df: DataFrame, key: str, fold: str, k: int, aggs: dict[str, Column], fit_on: Column | None = None
) -> DataFrame:
    """Per (key, fold) sums, and ``total - own fold`` as the statistics seen from each fold.

    ``aggs`` must be additive (sums and counts).  Returns (key, fit_fold, name...).
    The key table is repeated once per fold id (k is a parameter), not
    joined against anything.
    """
    src = df.filter(fit_on) if fit_on is not None else df
    per = src.groupBy(key, fold).agg(*[e.alias(n) for n, e in aggs.items()])
    tot = per.groupBy(key).agg(*[F.sum(n).alias(f"__t_{n}") for n in aggs])
    grid = tot.withColumn("fit_fold", F.explode(F.array(*[F.lit(i) for i in range(k)])))
    out = grid.join(per.withColumnRenamed(fold, "fit_fold"), [key, "fit_fold"], "left")
    return out.select(key, "fit_fold", *[(F.col(f"__t_{n}") - F.coalesce(F.col(n), F.lit(0))).alias(n) for n in aggs])


# ------------------------------------------------------------------ the fold feature pack (K7)

ENCODER_MODES = ("none", "plain", "loo", "oof")


def fold_encoder_stats(df: DataFrame, column: str, label: str, fold: str, k: int, inner: str, k_inner: int) -> DataFrame:
    """Label sum and count of every level as each fold's train part sees it, and each inner fold of that part.

    One aggregate per (level, fold, inner fold); then outside fold f is total - own(f), and inside that, outside the inner
    fold h, total - own(f) - inner(h) + both(f, h).  No row is copied.  Returns ``level, fit_fold, h, s, n``, with
    ``h`` -1 for the whole train part.  A null level is ``__MISSING__``; rows without a fold (test rows) take no part.
    """
    level = F.coalesce(F.col(column).cast("string"), F.lit(C.MISSING_TOKEN)).alias("level")
    y = F.col(label).cast("double")
    cell = df.where(F.col(fold).isNotNull()).groupBy(level, F.col(fold).alias("f"), F.col(inner).alias("h")).agg(F.sum(y).alias("s"), F.count(F.lit(1)).alias("n"))
    cell = materialize(cell, "encoder-cells")
    sums = [F.sum("s").alias("s"), F.sum("n").alias("n")]
    total = cell.groupBy("level").agg(*sums)
    own = cell.groupBy("level", "f").agg(*sums)
    part = cell.groupBy("level", "h").agg(*sums)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))

    def named(t: DataFrame, prefix: str) -> DataFrame:
        return t.withColumnsRenamed({"s": f"{prefix}_s", "n": f"{prefix}_n"})

    outer = total.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).join(named(own, "own"), ["level", "f"], "left")
    outer = outer.select("level", "f", (F.col("s") - zero("own_s")).alias("s"), (F.col("n") - zero("own_n")).alias("n"))
    deep = outer.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(k_inner - 1))))
    deep = deep.join(named(part, "part"), ["level", "h"], "left").join(named(cell, "both"), ["level", "f", "h"], "left")
    deep = deep.select("level", "f", "h", *[(F.col(c) - zero(f"part_{c}") + zero(f"both_{c}")).alias(c) for c in ("s", "n")])
    return outer.withColumn("h", F.lit(-1)).unionByName(deep).withColumnRenamed("f", "fit_fold").select("level", "fit_fold", "h", "s", "n")


def fold_encode(frame: DataFrame, df: DataFrame, column: str, label: str, fold: str, k: int, mode: str, name: str, smoothing: float, inner: str = "inner", k_inner: int = 5) -> DataFrame:
    """Adds ``name``: a level's smoothed label rate in the train part of ``fit_fold``.

    Valid and test rows, and train rows in mode ``plain``, get (s + g m) / (n + m) of the train part, ``g`` its label rate, or
    ``g`` for a level it lacks.  Train rows get their own label taken out in mode ``loo``, and the rate in the other
    inner folds of the train part in mode ``oof`` (``g`` of those rows; of the whole part for a level they lack).
    ``frame`` is :func:`fold_frame` of ``df`` (``role`` train, valid or test).
    """
    if mode not in ENCODER_MODES:
        raise ValueError(f"no encoder mode {mode}")
    if mode == "none":
        return frame
    st = materialize(fold_encoder_stats(df, column, label, fold, k, inner, k_inner), "encoder-stats")
    rate = materialize(st.groupBy("fit_fold", "h").agg((F.sum("s") / F.sum("n")).alias("__g")), "encoder-rates")  # k * (k_inner + 1) rows
    out = frame.withColumn("__level", F.coalesce(F.col(column).cast("string"), F.lit(C.MISSING_TOKEN)))
    out = out.withColumn("__h", F.when((F.col("role") == "train") & F.lit(mode == "oof"), F.col(inner)).otherwise(F.lit(-1)))
    own = st.where("n > 0").select(F.col("level").alias("__level"), "fit_fold", F.col("h").alias("__h"), F.col("s").alias("__s"), F.col("n").alias("__n"))
    out = lookup(out, own, ["__level", "fit_fold", "__h"])
    out = lookup(out, rate.withColumnRenamed("h", "__h"), ["fit_fold", "__h"], bound=k * (k_inner + 1))
    whole = rate.where("h = -1").select("fit_fold", F.col("__g").alias("__whole"))
    out = lookup(out, whole, ["fit_fold"], bound=k)
    m = F.lit(float(smoothing))
    plain = (F.col("__s") + F.col("__g") * m) / (F.col("__n") + m)
    less = F.col("__n") - 1 + m
    loo = F.when(less > 0, (F.col("__s") - F.col(label).cast("double") + F.col("__g") * m) / less).otherwise(F.col("__g"))
    value = F.when((F.col("role") == "train") & F.lit(mode == "loo"), loo).otherwise(plain)
    return out.withColumn(name, F.coalesce(value, F.col("__whole"))).drop("__level", "__h", "__s", "__n", "__g", "__whole")


def fold_value_counts(frame: DataFrame, df: DataFrame, column: str, fold: str, k: int, name: str) -> DataFrame:
    """Adds ``name``: how often a value stands in the train part of ``fit_fold`` (0 for a null or unseen one)."""
    st = fold_additive_stats(df.where(F.col(fold).isNotNull()), column, fold, k, {name: F.count(F.lit(1))}, fit_on=F.col(column).isNotNull())
    out = lookup(frame, st, [column, "fit_fold"])
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint"))


def fold_bins(frame: DataFrame, column: str, k: int, bins: int, name: str, prefix: str = "Bin_", fit: DataFrame | None = None) -> DataFrame:
    """Adds ``name``: right-closed bins at the ``i / bins`` quantiles of the train part's values (equal edges merged); null is its own bin.

    ``fit`` has the same rows with no more than ``fit_fold``, ``role`` and the column, for the quantiles' pass.
    """
    from tessera.operators.profile import exact_quantiles

    fit = (frame if fit is None else fit).where((F.col("role") == "train") & F.col(column).isNotNull())
    q = exact_quantiles(fit, [column], [i / bins for i in range(1, bins)], by=["fit_fold"])
    edges = q.select("fit_fold", F.array_sort(F.array_distinct(F.array(*[F.col(f"q{i}") for i in range(bins - 1)]))).alias("__edges"))
    out = lookup(frame, edges, ["fit_fold"], bound=k)
    place = F.size(F.filter(F.coalesce("__edges", F.array().cast("array<double>")), lambda e: e < F.col(column))) + 1
    return out.withColumn(name, F.when(F.col(column).isNull(), f"{prefix}Missing").otherwise(F.concat(F.lit(prefix), place.cast("string")))).drop("__edges")


def group_aggregates(frame: DataFrame, df: DataFrame, group: str, age: str, total: str, flag: str) -> DataFrame:
    """Adds the five aggregates of a group over all rows of ``df`` (no label is used; a null group is a group)."""
    st = df.groupBy(group).agg(
        F.avg(age).alias("group_mean_age"), F.max(total).alias("group_max_spend"), F.avg(total).alias("group_mean_spend"),
        F.max(F.coalesce(F.col(flag) == "True", F.lit(False)).cast("int")).alias("group_has_flag"), F.count(F.lit(1)).alias("group_size_from_ids"),
    )
    return lookup(frame, st, [group], null_safe=True)


def fold_feature_pack(
    df: DataFrame, label: str, fold: str, k: int, encode: Sequence[str], mode: str, *, surname: str, group: str, number: str, age: str, total: str, flag: str,
    smoothing: float = 20.0, rate_smoothing: float = 10.0, bins: int = 5, inner: str = "inner", k_inner: int = 5,
) -> DataFrame:
    """K7: one row per row and fold (``fit_fold``, ``role``) with everything a fold's model may see of the train part.

    ``te_<column>`` in the given mode, surname count and rate (leave-one-out on train rows), bins of ``number``, five
    group aggregates.  Rows whose ``fold`` is null are test rows of every fold.
    """
    df = materialize(df, "pack-rows")
    # a group's values are the same in every fold: joined to the rows before these are copied to the folds
    frame = fold_frame(group_aggregates(df, df, group, age, total, flag), fold, k).withColumn("role", F.when(F.col(fold).isNull(), "test").otherwise(F.col("role")))
    own = fold_frame(df.select(fold, number), fold, k).withColumn("role", F.when(F.col(fold).isNull(), "test").otherwise(F.col("role")))
    frame = fold_bins(frame, number, k, bins, f"{number}_bin", fit=own)
    for c in encode:
        frame = fold_encode(frame, df, c, label, fold, k, mode, f"te_{c}", smoothing, inner, k_inner)
    frame = fold_value_counts(frame, df, surname, fold, k, f"{surname}_freq")
    return fold_encode(frame, df, surname, label, fold, k, "loo", f"{surname}_rate", rate_smoothing, inner, k_inner)
