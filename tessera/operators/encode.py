"""Categorical and text encoders.

Every encoder is a fit that returns a small DataFrame keyed by level (and by
fold for fold-local fits) plus an apply that joins it back.  Level tables
are bounded by the column's cardinality; when a cardinality is large the
join stays a shuffle join (AQE decides), never a driver-side map.

Out-of-fold target encoding is additive: per (level, fold) sums and counts,
then ``total - own fold`` gives each fold's statistics without copying rows
k times and without a loop over folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import MISSING_TOKEN
from tessera.operators.core import attach_row, lookup, ordered_index

# Fixed values of the reference's encoders.
DEFAULT_SMOOTHING = 20.0
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"  # two or more word characters, as sklearn's default token pattern
MAX_FEATURES = 1000
RANK_TOLERANCE = 1e-9  # singular values below this share of the largest are none, as in RowMatrix.computeSVD


def level_col(c: str) -> Column:
    """Encoder key: the value as text, null as ``__MISSING__``."""
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TOKEN))


# ------------------------------------------------------------------ levels, one-hot, ordinal


def level_index(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """(column_name, level, idx): non-null levels of every column, alphabetical index from 0.

    One unpivot + distinct; the distinct levels are numbered per column with
    :func:`core.ordered_index` (range partitioning), so a column with many
    levels is not ranked in one task.
    """
    src = df.filter(fit_on) if fit_on is not None else df
    long = src.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "level")
    lv = long.filter(F.col("level").isNotNull()).distinct()
    idx = ordered_index(lv, ["level"], by=["column_name"], name="__rn")
    return idx.select("column_name", "level", (F.col("__rn") - 1).cast("int").alias("idx"))


def ordinal_encode(df: DataFrame, columns: Sequence[str], levels: DataFrame, unknown: int = -1) -> DataFrame:
    """Alphabetical train index per column; unseen or null -> ``unknown``."""
    out = df
    for c in columns:
        t = levels.filter(F.col("column_name") == c).select(F.col("level").alias(f"__lv_{c}"), F.col("idx").alias(f"{c}_ord"))
        out = out.join(t, F.col(c).cast("string") == F.col(f"__lv_{c}"), "left").drop(f"__lv_{c}")
        out = out.withColumn(f"{c}_ord", F.coalesce(F.col(f"{c}_ord"), F.lit(unknown)).cast("int"))
    return out


def one_hot(df: DataFrame, column: str, fit_on: Column | None = None, name: str | None = None) -> DataFrame:
    """One-hot with train levels, unseen/null -> all zeros, as an ``array<double>`` column.

    Levels are numbered in their order (:func:`level_index`) and joined to the rows, so no level list passes
    through the driver; only their number does, which is the width of the arrays.
    """
    name = name or f"{column}_ohe"
    levels = level_index(df, [column], fit_on).select(F.col("level").alias("__lv"), F.col("idx").alias("__idx"))
    width = levels.count()
    out = df.join(levels, F.col(column).cast("string") == F.col("__lv"), "left")
    slots = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce((i == F.col("__idx")).cast("double"), F.lit(0.0)))
    return out.withColumn(name, slots if width else F.array().cast("array<double>")).drop("__lv", "__idx")


def native_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shared level index over all splits (strings as categories); null -> -1."""
    levels = level_index(df, columns)
    return ordinal_encode(df, columns, levels)


# ------------------------------------------------------------------ target encoders


def target_stats(df: DataFrame, column: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per level (and ``by`` keys): label sum and row count."""
    return df.groupBy(*by, level_col(column).alias("__level")).agg(
        F.sum(F.col(label).cast("double")).alias("__s"), F.count(F.lit(1)).alias("__n")
    )


def target_encode(
    df: DataFrame, column: str, label: str, fit_on: Column, smoothing: float = DEFAULT_SMOOTHING, name: str | None = None
) -> DataFrame:
    """(sum + g * m) / (n + m) fitted on ``fit_on`` rows; unseen -> g; null level is a level."""
    name = name or f"te_{column}"
    fit = df.filter(fit_on)
    g = fit.agg(F.avg(F.col(label).cast("double")).alias("__g"))
    st = target_stats(fit, column, label)
    out = lookup(df.withColumn("__level", level_col(column)), st, ["__level"])
    out = attach_row(out, g)
    enc = (F.col("__s") + F.col("__g") * smoothing) / (F.col("__n") + smoothing)
    return out.withColumn(name, F.coalesce(enc, F.col("__g"))).drop("__level", "__s", "__n", "__g")


def target_encode_loo(
    df: DataFrame, column: str, label: str, fit_on: Column, smoothing: float = DEFAULT_SMOOTHING, name: str | None = None
) -> DataFrame:
    """Leave-one-out on the fit rows, (sum - y + g m) / (n - 1 + m); other rows get J18.

    Leaks the label (see SURVEY §6); kept for the encoder comparison only.
    """
    name = name or f"te_{column}"
    fit = df.filter(fit_on)
    g = fit.agg(F.avg(F.col(label).cast("double")).alias("__g"))
    st = target_stats(fit, column, label)
    out = attach_row(lookup(df.withColumn("__level", level_col(column)), st, ["__level"]), g)
    y = F.col(label).cast("double")
    loo_den = F.col("__n") - 1 + smoothing
    loo = F.when(loo_den > 0, (F.col("__s") - y + F.col("__g") * smoothing) / loo_den).otherwise(F.col("__g"))
    plain = F.coalesce((F.col("__s") + F.col("__g") * smoothing) / (F.col("__n") + smoothing), F.col("__g"))
    return out.withColumn(name, F.when(fit_on, loo).otherwise(plain)).drop("__level", "__s", "__n", "__g")


def target_encode_oof(
    df: DataFrame,
    column: str,
    label: str,
    fit_on: Column,
    fold: str,
    smoothing: float = DEFAULT_SMOOTHING,
    name: str | None = None,
) -> DataFrame:
    """Each fit row is encoded from the other folds; other rows from all fit rows.

    Level statistics outside fold f = level total - level total in f, and the
    fold's own prior g_f likewise; a level absent from the other folds gets
    the overall fit mean.  One aggregate keyed by (level, fold), no loop.
    """
    name = name or f"te_{column}"
    fit = df.filter(fit_on)
    per_fold = target_stats(fit, column, label, by=[fold])
    totals = per_fold.groupBy("__level").agg(F.sum("__s").alias("__tot_s"), F.sum("__n").alias("__tot_n"))
    gf = fit.groupBy(fold).agg(F.sum(F.col(label).cast("double")).alias("__fold_s"), F.count(F.lit(1)).alias("__fold_n"))
    gall = fit.agg(F.sum(F.col(label).cast("double")).alias("__all_s"), F.count(F.lit(1)).alias("__all_n"))
    out = df.withColumn("__level", level_col(column))
    out = lookup(out, totals, ["__level"])
    out = lookup(out, per_fold, ["__level", fold])
    out = lookup(out, gf, [fold], bound=1000)  # one row per fold
    out = attach_row(out, gall)
    g_all = F.col("__all_s") / F.col("__all_n")
    n_out = F.col("__tot_n") - F.coalesce(F.col("__n"), F.lit(0))
    s_out = F.col("__tot_s") - F.coalesce(F.col("__s"), F.lit(0.0))
    g_f = (F.col("__all_s") - F.col("__fold_s")) / (F.col("__all_n") - F.col("__fold_n"))
    oof = F.when(n_out > 0, (s_out + g_f * smoothing) / (n_out + smoothing)).otherwise(g_all)
    plain = F.coalesce((F.col("__tot_s") + g_all * smoothing) / (F.col("__tot_n") + smoothing), g_all)
    out = out.withColumn(name, F.when(fit_on, oof).otherwise(plain))
    return out.drop("__level", "__tot_s", "__tot_n", "__s", "__n", "__fold_s", "__fold_n", "__all_s", "__all_n")


def category_stat_encodings(df: DataFrame, column: str, label: str, fit_on: Column) -> DataFrame:
    """Target order, log count, count-rank label and log1p(pos/neg) per train level.

    * ``_target``: index of the level when levels are sorted by label mean (ties by level)
    * ``_count``: log1p(train count)
    * ``_count_label``: levels by count descending get L, L-1, ..., 1 (ties by level)
    * ``_woe``: log1p(pos / neg), null when neg = 0
    Null or unseen levels get null.  Levels are numbered with
    :func:`core.ordered_index` over the level table (one row per level).
    """
    fit = df.filter(fit_on & F.col(column).isNotNull())
    st = fit.groupBy(column).agg(
        F.avg(F.col(label).cast("double")).alias("__m"),
        F.count(F.lit(1)).alias("__c"),
        F.sum(F.col(label).cast("double")).alias("__pos"),
    )
    by_mean = ordered_index(st, ["__m", column], name="__r_m", count_name="__levels")
    by_count = ordered_index(st.select(column, "__c"), [F.desc("__c"), F.asc(column)], name="__r_c").drop("__c")
    st = by_mean.join(by_count, column).select(
        column,
        (F.col("__r_m") - 1).cast("int").alias(f"{column}_target"),
        F.log1p("__c").alias(f"{column}_count"),
        (F.col("__levels") - F.col("__r_c") + 1).cast("int").alias(f"{column}_count_label"),
        F.log1p(F.try_divide(F.col("__pos"), F.when(F.col("__c") - F.col("__pos") == 0, None).otherwise(F.col("__c") - F.col("__pos"))))
        .alias(f"{column}_woe"),
    )
    return lookup(df, st, [column])


# ------------------------------------------------------------------ TF-IDF and SVD


def tokens(text: Column) -> Column:
    """Lower-cased tokens of two or more word characters over the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def tfidf(df: DataFrame, id_col: str, text: str, max_features: int = MAX_FEATURES, fit_on: Column | None = None) -> DataFrame:
    """(id, term, weight) with raw term counts, smooth idf ln((1+n)/(1+df)) + 1 and L2 row norm.

    The vocabulary is the ``max_features`` terms with the highest corpus
    count (ties by term): a take-ordered limit, so it is bounded by the
    parameter and broadcast.  Documents are tokenised whole.  Vocabulary and idf
    come from the ``fit_on`` rows (all, if None); every row is transformed.
    """
    fit = F.lit(True) if fit_on is None else fit_on
    src = df.select(id_col, fit.alias("__fit"), F.explode(tokens(F.col(text))).alias("term"))
    tf = src.groupBy(id_col, "__fit", "term").agg(F.count(F.lit(1)).alias("tf"))
    n_docs = df.filter(fit).agg(F.count(F.lit(1)).alias("__nd"))
    stats = tf.filter("__fit").groupBy("term").agg(F.sum("tf").alias("__tot"), F.count(F.lit(1)).alias("__df"))
    vocab = stats.orderBy(F.desc("__tot"), "term").limit(max_features)
    vocab = attach_row(vocab, n_docs).select(
        "term", (F.log((1 + F.col("__nd")) / (1 + F.col("__df"))) + 1).alias("__idf")
    )
    v = tf.join(F.broadcast(vocab), "term").withColumn("__w", F.col("tf") * F.col("__idf"))
    norm = v.groupBy(id_col).agg(F.sqrt(F.sum(F.col("__w") * F.col("__w"))).alias("__norm"))
    return v.join(norm, id_col).select(id_col, "term", (F.col("__w") / F.col("__norm")).alias("weight"))


def tfidf_svd(weights: DataFrame, id_col: str, ids: DataFrame, k: int = 5) -> DataFrame:
    """Truncated SVD of the TF-IDF matrix (k components), every row of ``ids`` projected onto V.

    One pass over the documents adds up the Gram matrix of the terms (``RowMatrix``; vocabulary x vocabulary
    numbers, so bounded by ``max_features``), whose eigenvectors are the right singular vectors: an
    iterative SVD would read every document again for each of its steps.  The loadings are a table
    (term, component, loading) of at most vocabulary x k rows; the projection is its join with the weights
    and a sum per document.  Documents without a vocabulary term are all zeros.  The sign of each component
    makes its largest loading positive.
    """
    import numpy as np
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix

    vocab = weights.select("term").distinct()
    terms = vocab.withColumn("__j", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    names = [r["term"] for r in terms.orderBy("__j").collect()]  # the vocabulary, bounded by max_features
    n_terms = len(names)
    k = int(min(k, max(1, n_terms - 1)))
    rows = weights.join(F.broadcast(terms), "term").groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("__j", "weight"))).alias("__e")  # at most max_features entries
    )
    matrix = rows.rdd.map(lambda r: Vectors.sparse(n_terms, [(e[0], e[1]) for e in r["__e"]]))
    values, vectors = np.linalg.eigh(RowMatrix(matrix, numCols=n_terms).computeGramianMatrix().toArray())
    sigma, v = np.sqrt(np.maximum(values[::-1][:k], 0.0)), vectors[:, ::-1][:, :k]
    v = v[:, sigma > RANK_TOLERANCE * sigma[0]]
    table = []
    for c in range(v.shape[1]):
        sign = -1.0 if v[abs(v[:, c]).argmax(), c] < 0 else 1.0
        table += [(names[j], c, float(sign * v[j, c])) for j in range(n_terms)]
    loadings = weights.sparkSession.createDataFrame(table, "term string, component int, loading double")
    parts = [F.sum(F.when(F.col("component") == c, F.col("weight") * F.col("loading"))).alias(f"svd_{c}") for c in range(k)]
    found = weights.join(F.broadcast(loadings), "term").groupBy(id_col).agg(*parts)
    return ids.select(id_col).join(found, id_col, "left").fillna(0.0, subset=[f"svd_{c}" for c in range(k)])
