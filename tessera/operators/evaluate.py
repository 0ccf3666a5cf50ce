"""Evaluation operators: metrics, AUC, curves, threshold tables.

Every metric is an aggregate over (score, label) rows grouped by the keys
(family, fold, ...), so k folds x f families is one job.  Ranking metrics
first collapse rows to distinct scores (pos/neg counts per score) and take
running sums over the score order with :func:`core.running_totals`, so a
family with a third of the rows is not sorted in one task.  Threshold scans
bucket the scores to the threshold grid first: the cumulative window then
runs over at most grid-size rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.core import attach_row, lookup, running_totals

# Fixed values of the reference's evaluation.
LOGLOSS_CLIP = 1e-6


def _y(label: str) -> Column:
    return F.col(label).cast("double")


def binary_metrics(df: DataFrame, score: str, label: str, threshold: float | Column = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 when undefined), log-loss, positive rate, count."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    pred = (F.col(score) >= t).cast("double")
    y = _y(label)
    p = F.least(F.greatest(F.col(score), F.lit(LOGLOSS_CLIP)), F.lit(1 - LOGLOSS_CLIP))
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(pred * y).alias("tp"),
        F.sum(pred * (1 - y)).alias("fp"),
        F.sum((1 - pred) * y).alias("fn"),
        F.sum((1 - pred) * (1 - y)).alias("tn"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("logloss"),
    )
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    return agg.select(
        *by,
        ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"),
        "logloss",
        ((F.col("tp") + F.col("fp")) / F.col("n")).alias("positive_rate"),
        (F.col("tp") + F.col("fp")).cast("bigint").alias("positives"),
        F.col("n").cast("bigint").alias("n"),
    )


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, score, pos, neg) per distinct score: the input of every ranking metric."""
    y = _y(label)
    return df.groupBy(*by, score).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """M3: tie-aware ROC AUC (rank-sum with average ranks); null when one class only."""
    d = running_totals(score_counts(df, score, label, by), [score], by, ["neg"])
    part = d.select(*by, "pos", "neg", (F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("__c"))
    s = part.groupBy(*by).agg(F.sum("__c").alias("__c"), F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    return s.select(*by, F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__c") / (F.col("__p") * F.col("__n"))).alias("auc"))


def roc_pr_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """M4: one point per distinct score (descending): fpr, tpr, precision, recall."""
    d = running_totals(score_counts(df, score, label, by), [F.desc(score)], by, ["pos", "neg"])
    tot = d.groupBy(*by).agg(F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    d = _attach(d, tot, by)
    return d.select(
        *by, F.col(score).alias("threshold"),
        F.try_divide(F.col("cum_neg"), F.col("__N")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.col("__P")).alias("tpr"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide(F.col("cum_pos"), F.col("__P")).alias("recall"),
        (F.col("pos") / F.col("__P")).alias("__dr"),
    )


def _attach(d: DataFrame, tot: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per-key (or one global) statistics row attached to every row."""
    return lookup(d, tot, list(by)) if by else attach_row(d, tot)


def pr_auc(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average precision: sum over points of (recall step) x precision."""
    return curve.groupBy(*by).agg(F.sum(F.col("__dr") * F.col("precision")).alias("pr_auc"))


def confusion(df: DataFrame, score: str, label: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """M5: counts per (label, prediction)."""
    pred = (F.col(score) >= threshold).cast("int")
    return df.groupBy(*by, F.col(label).cast("int").alias("y"), pred.alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def threshold_scan(
    df: DataFrame, score: str, label: str, lo: int = 30, hi: int = 70, scale: int = 100, by: Sequence[str] = ()
) -> DataFrame:
    """M6: metrics at every threshold i/scale for i in [lo, hi], in one pass.

    Each row goes to bucket b = floor(score * scale) clipped to [lo - 1, hi];
    predictions at threshold i are the rows with b >= i, so reverse running
    sums over at most (hi - lo + 2) buckets per key give every threshold.
    """
    y = _y(label)
    # the product may round to the wrong side of a threshold, so the bucket is settled by the thresholds themselves
    b = F.floor(F.col(score) * scale)
    b = F.when(F.col(score) >= (b + 1) / F.lit(float(scale)), b + 1).when(F.col(score) < b / F.lit(float(scale)), b - 1).otherwise(b)
    b = F.least(F.greatest(b, F.lit(lo - 1)), F.lit(hi)).cast("int")
    per = df.where(F.col(score).isNotNull()).groupBy(*by, b.alias("b")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    # a key's buckets in one row, at most as many as the grid has; gaps of the grid are 0.  The windows keep that partitioning.
    held = per.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("b", F.struct("pos", "neg")))).alias("__m"))
    full = held.select(*by, "__m", F.explode(F.sequence(F.lit(lo - 1), F.lit(hi))).alias("b"))
    cell = F.try_element_at("__m", F.col("b"))
    full = full.select(*by, "b", *[F.coalesce(cell[c], F.lit(0.0)).alias(c) for c in ("pos", "neg")])
    w_rev = Window.partitionBy(*by).orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(*by)
    t = full.select(
        *by, "b",
        F.sum("pos").over(w_rev).alias("tp"), F.sum("neg").over(w_rev).alias("fp"),
        F.sum("pos").over(w_all).alias("P"), F.sum("neg").over(w_all).alias("N"),
    ).filter(F.col("b") >= lo)
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("P")), F.lit(0.0))
    return t.select(
        *by,
        (F.col("b") / F.lit(float(scale))).alias("threshold"),
        ((F.col("tp") + F.col("N") - F.col("fp")) / (F.col("P") + F.col("N"))).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"),
    )


def best_threshold(scan: DataFrame, by: Sequence[str] = (), metric: str = "accuracy", rule: str = "nearest_half") -> DataFrame:
    """M7/M8/H6: the threshold to use per key.

    * ``nearest_half``: best metric; ties -> nearest to 0.5 -> smaller (M7)
    * ``first``: best metric; ties -> smallest threshold (scan order)
    * ``strict_gain``: 0.5 unless another threshold is strictly better (M8)
    """
    if rule == "nearest_half":
        key = F.struct(F.col(metric), -F.abs(F.col("threshold") - 0.5), -F.col("threshold"))
    else:
        key = F.struct(F.col(metric), -F.col("threshold"))
    best = scan.groupBy(*by).agg(F.max_by(F.struct("threshold", metric), key).alias("__b"))
    best = best.select(*by, F.col("__b.threshold").alias("threshold"), F.col(f"__b.{metric}").alias(metric))
    if rule != "strict_gain":
        return best
    half = scan.filter(F.col("threshold") == 0.5).select(*by, F.col(metric).alias("__half"))
    out = _attach(best, half, by)
    gain = F.col(metric) > F.coalesce(F.col("__half"), F.lit(-1.0))
    return out.select(
        *by,
        F.when(gain, F.col("threshold")).otherwise(F.lit(0.5)).alias("threshold"),
        F.when(gain, F.col(metric)).otherwise(F.col("__half")).alias(metric),
    )


def calibration(df: DataFrame, score: str, label: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean score, mean label and count per score bin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(*by, b.alias("bin")).agg(
        F.avg(score).alias("mean_p"), F.avg(_y(label)).alias("mean_y"), F.count(F.lit(1)).alias("n")
    )


def rule_audit(
    df: DataFrame, score: str, label: str, rule_up: Column, rule_down: Column, boost: float = 0.05, penalty: float = 0.10,
    by: Sequence[str] = (),
) -> DataFrame:
    """Predictions a score nudge would flip, how many flips are right, accuracy before/after."""
    p = F.col(score)
    nudged = F.when(rule_up, p + boost).when(rule_down, p - penalty).otherwise(p)
    nudged = F.least(F.greatest(nudged, F.lit(LOGLOSS_CLIP)), F.lit(1 - LOGLOSS_CLIP))
    base = (p >= 0.5).cast("int")
    new = (nudged >= 0.5).cast("int")
    y = F.col(label).cast("int")
    flipped = base != new
    agg = df.groupBy(*by).agg(
        F.sum(flipped.cast("bigint")).alias("flipped"),
        F.sum((flipped & (new == y)).cast("bigint")).alias("correct_flip"),
        F.avg((base == y).cast("double")).alias("base_acc"),
        F.avg((new == y).cast("double")).alias("rule_acc"),
    )
    return agg.select(
        *by, "flipped", "correct_flip", (F.col("flipped") - F.col("correct_flip")).alias("wrong_flip"),
        (2 * F.col("correct_flip") - F.col("flipped")).alias("delta_correct"),
        "base_acc", "rule_acc", (F.col("rule_acc") - F.col("base_acc")).alias("delta_acc"),
    )
