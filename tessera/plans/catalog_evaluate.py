"""Queries of SURVEY §2.M (evaluation), plus H6 (arg-max) and F14 (fold metric statistics).

Scores are fixture P (families f1..f4 over W's ids) restricted to the
labelled training split, the out-of-fold frame of the reference.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import evaluate as EV
from tessera.plans.registry import register
from tessera.plans.sqlparts import sql_hash_bucket
from tessera.plans.util import rounded
from tessera.sources.fixtures import predictions, wide


def _oof(spark, sf_dir):
    return predictions(spark, sf_dir).filter(F.col("split") == "train")


_ROUNDED_METRICS = ["accuracy", "precision", "recall", "f1", "logloss", "positive_rate"]
_EXACT_METRICS_SQL = """
    SELECT {keys}, ((tp + tn) / n) AS accuracy, (coalesce(tp / nullif(tp + fp, 0), 0.0)) AS precision,
           (coalesce(tp / nullif(tp + fn, 0), 0.0)) AS recall,
           (CASE WHEN coalesce(tp / nullif(tp + fp, 0), 0.0) + coalesce(tp / nullif(tp + fn, 0), 0.0) > 0
                 THEN 2 * coalesce(tp / nullif(tp + fp, 0), 0.0) * coalesce(tp / nullif(tp + fn, 0), 0.0)
                      / (coalesce(tp / nullif(tp + fp, 0), 0.0) + coalesce(tp / nullif(tp + fn, 0), 0.0)) ELSE 0.0 END) AS f1,
           (logloss) AS logloss, ((tp + fp) / n) AS positive_rate, CAST(tp + fp AS BIGINT) AS positives,
           CAST(n AS BIGINT) AS n
    FROM (SELECT {keys}, count(*) AS n, sum(CAST(p >= {t} AS DOUBLE) * y) AS tp, sum(CAST(p >= {t} AS DOUBLE) * (1 - y)) AS fp,
                 sum((1 - CAST(p >= {t} AS DOUBLE)) * y) AS fn, sum((1 - CAST(p >= {t} AS DOUBLE)) * (1 - y)) AS tn,
                 avg(-(y * ln(least(greatest(p, 1e-6), 1 - 1e-6)) + (1 - y) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6)))) AS logloss
          FROM {src} GROUP BY {keys}) t"""
_METRICS_SQL = "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED_METRICS) + ") FROM (" + _EXACT_METRICS_SQL + ") e"


@register(
    "m_binary_metrics", "M1/M2/M12",
    sql=_METRICS_SQL.format(keys="family", t="0.5", src="(SELECT * FROM p WHERE split = 'train') s"),
    fixtures=("p",),
)
def m_binary_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1, clipped log-loss, positive rate and count at 0.5."""
    return rounded(EV.binary_metrics(_oof(spark, sf_dir), "p", "y", 0.5, by=["family"]))


_AUC_SQL = """
    d AS (SELECT {keys}, p, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY {keys}, p),
    c AS (SELECT *, sum(neg) OVER (PARTITION BY {keys} ORDER BY p ROWS UNBOUNDED PRECEDING) AS cum_neg FROM d),
    a AS (SELECT {keys}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                  THEN sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) END AS auc FROM c GROUP BY {keys})"""


@register(
    "m_auc", "M3",
    sql="WITH " + _AUC_SQL.format(keys="family", src="(SELECT * FROM p WHERE split = 'train') s")
        + " SELECT family, round(auc, 6) AS auc FROM a",
    fixtures=("p",),
)
def m_auc(spark, sf_dir):
    """M3: tie-aware ROC AUC per family (distinct-score counts + distributed running sums)."""
    return rounded(EV.auc(_oof(spark, sf_dir), "p", "y", by=["family"]))


@register(
    "m_auc_one_class", "M3",
    sql="WITH " + _AUC_SQL.format(keys="family", src="(SELECT * FROM p WHERE split = 'train' AND y = 1) s")
        + " SELECT family, auc FROM a",
    fixtures=("p",),
)
def m_auc_one_class(spark, sf_dir):
    """M3 edge: only one class present -> AUC is null."""
    return EV.auc(_oof(spark, sf_dir).filter(F.col("y") == 1), "p", "y", by=["family"])


_CURVE_SQL = """
    WITH d AS (SELECT family, p, sum(y) AS pos, sum(1 - y) AS neg FROM p WHERE split = 'train' GROUP BY family, p),
    c AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
                 sum(pos) OVER (PARTITION BY family) AS tp_all, sum(neg) OVER (PARTITION BY family) AS tn_all
          FROM d WINDOW w AS (PARTITION BY family ORDER BY p DESC ROWS UNBOUNDED PRECEDING))"""


@register(
    "m_roc_pr_curve", "M4",
    sql=_CURVE_SQL + """
    SELECT family, round(p, 6) AS threshold, round(cum_neg / tn_all, 6) AS fpr, round(cum_pos / tp_all, 6) AS tpr,
           round(cum_pos / (cum_pos + cum_neg), 6) AS precision, round(cum_pos / tp_all, 6) AS recall FROM c""",
    fixtures=("p",),
)
def m_roc_pr_curve(spark, sf_dir):
    """M4: ROC and PR points, one per distinct score."""
    return rounded(EV.roc_pr_curve(_oof(spark, sf_dir), "p", "y", by=["family"]).drop("__dr"))


@register(
    "m_pr_auc", "M4",
    sql=_CURVE_SQL + " SELECT family, round(sum(pos / tp_all * cum_pos / (cum_pos + cum_neg)), 6) AS pr_auc FROM c GROUP BY family",
    fixtures=("p",),
)
def m_pr_auc(spark, sf_dir):
    """M4: area under the PR curve as average precision."""
    return rounded(EV.pr_auc(EV.roc_pr_curve(_oof(spark, sf_dir), "p", "y", by=["family"]), by=["family"]))


#: Threshold grids (first, last and steps per unit), besides .30-.70 by hundredths.
GRIDS = {"thousandths": (350, 650, 1000), "wide": (10, 190, 200), "narrow": (88, 108, 200)}


@register(
    "m_threshold_grids", "M6",
    sql="WITH " + _AUC_SQL.format(keys="family", src="(SELECT * FROM p WHERE split = 'train') s")
        + ", m AS (" + _EXACT_METRICS_SQL.format(keys="family", t="0.5", src="(SELECT * FROM p WHERE split = 'train') s") + "), g AS ("
        + " UNION ALL ".join(f"SELECT '{g}' AS grid, i / {n}.0::DOUBLE AS threshold FROM range({lo}, {hi + 1}) t(i)" for g, (lo, hi, n) in GRIDS.items())
        + """), t AS (SELECT family, grid, threshold, sum(CASE WHEN p >= threshold THEN y ELSE 0 END) AS tp,
                 sum(CASE WHEN p >= threshold THEN 1 - y ELSE 0 END) AS fp, sum(y) AS P, sum(1 - y) AS N
          FROM p, g WHERE split = 'train' GROUP BY family, grid, threshold),
    s AS (SELECT family, grid, threshold, (tp + N - fp) / (P + N) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
                 coalesce(tp / nullif(P, 0), 0.0) AS recall FROM t)
    SELECT s.family, grid, round(threshold, 6) AS threshold, round(s.accuracy, 6) AS accuracy, round(s.precision, 6) AS precision,
           round(s.recall, 6) AS recall,
           round(CASE WHEN s.precision + s.recall > 0 THEN 2 * s.precision * s.recall / (s.precision + s.recall) ELSE 0.0 END, 6) AS f1,
           round(auc, 6) AS auc, round(logloss, 6) AS logloss
    FROM s JOIN a ON s.family = a.family JOIN m ON s.family = m.family""",
    fixtures=("p",),
)
def m_threshold_grids(spark, sf_dir):
    """M6: every threshold of the three finer grids, with the family's AUC and log-loss."""
    s = _oof(spark, sf_dir)
    out = None
    for name, (lo, hi, n) in GRIDS.items():
        part = EV.threshold_scan(s, "p", "y", lo, hi, n, by=["family"]).withColumn("grid", F.lit(name))
        out = part if out is None else out.unionByName(part)
    whole = EV.auc(s, "p", "y", by=["family"]).join(EV.binary_metrics(s, "p", "y", 0.5, by=["family"]).select("family", "logloss"), "family")
    return rounded(out.join(whole, "family"))


@register(
    "m_confusion", "M5",
    sql="SELECT family, CAST(y AS INTEGER) AS y, CAST(p >= 0.5 AS INTEGER) AS pred, CAST(count(*) AS BIGINT) AS n "
        "FROM p WHERE split = 'train' GROUP BY ALL",
    fixtures=("p",),
)
def m_confusion(spark, sf_dir):
    """M5: confusion matrix at 0.5 per family."""
    return EV.confusion(_oof(spark, sf_dir), "p", "y", 0.5, by=["family"])


_SCAN_SQL = """
    t AS (SELECT family, b, sum(CASE WHEN p >= b / 100.0::DOUBLE THEN y ELSE 0 END) AS tp,
                 sum(CASE WHEN p >= b / 100.0::DOUBLE THEN 1 - y ELSE 0 END) AS fp, sum(y) AS P, sum(1 - y) AS N
          FROM p, range(30, 71) g(b) WHERE split = 'train' GROUP BY family, b),
    scan AS (SELECT family, b / 100.0 AS threshold, (tp + N - fp) / (P + N) AS accuracy,
                    coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(P, 0), 0.0) AS recall
             FROM t WHERE b >= 30)"""


@register(
    "m_threshold_scan", "M6",
    sql="WITH " + _SCAN_SQL + """
    SELECT family, round(threshold, 6) AS threshold, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
           round(recall, 6) AS recall,
           round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1
    FROM scan""",
    fixtures=("p",),
)
def m_threshold_scan(spark, sf_dir):
    """M6: metrics at thresholds .30-.70 step .01 in one pass (bucket, then reverse running sums)."""
    return rounded(EV.threshold_scan(_oof(spark, sf_dir), "p", "y", 30, 70, 100, by=["family"]))


@register(
    "m_best_threshold", "M7",
    sql="WITH " + _SCAN_SQL + """
    SELECT family, round(arg_max(threshold, [accuracy, -abs(threshold - 0.5), -threshold]), 6) AS threshold,
           round(max(accuracy), 6) AS accuracy FROM scan GROUP BY family""",
    fixtures=("p",),
)
def m_best_threshold(spark, sf_dir):
    """M7: best accuracy; ties -> nearest 0.5 -> smaller threshold."""
    scan = EV.threshold_scan(_oof(spark, sf_dir), "p", "y", 30, 70, 100, by=["family"])
    return rounded(EV.best_threshold(scan, ["family"], "accuracy", "nearest_half"))


@register(
    "m_threshold_strict_gain", "M8",
    sql="WITH " + _SCAN_SQL + """,
    best AS (SELECT family, arg_max(threshold, [accuracy, -threshold]) AS t, max(accuracy) AS acc FROM scan GROUP BY family),
    half AS (SELECT family, accuracy AS acc_half FROM scan WHERE threshold = 0.5)
    SELECT family, round(CASE WHEN acc > coalesce(acc_half, -1.0) THEN t ELSE 0.5 END, 6) AS threshold,
           round(CASE WHEN acc > coalesce(acc_half, -1.0) THEN acc ELSE acc_half END, 6) AS accuracy
    FROM best LEFT JOIN half USING (family)""",
    fixtures=("p",),
)
def m_threshold_strict_gain(spark, sf_dir):
    """M8: keep 0.5 unless a threshold is strictly better (first maximum otherwise)."""
    scan = EV.threshold_scan(_oof(spark, sf_dir), "p", "y", 30, 70, 100, by=["family"])
    return rounded(EV.best_threshold(scan, ["family"], "accuracy", "strict_gain"))


@register(
    "h_argmax", "H6",
    sql="WITH " + _SCAN_SQL + """
    SELECT round(arg_max(threshold, [accuracy, -threshold]), 6) AS threshold,
           arg_max(family, [accuracy, -threshold]) AS family, round(max(accuracy), 6) AS accuracy FROM scan""",
    fixtures=("p",),
)
def h_argmax(spark, sf_dir):
    """H6: the best (family, threshold) trial by ordered keys (accuracy, then earliest threshold) via max_by."""
    scan = EV.threshold_scan(_oof(spark, sf_dir), "p", "y", 30, 70, 100, by=["family"])
    best = scan.agg(F.max_by(F.struct("threshold", "family", "accuracy"), F.struct("accuracy", -F.col("threshold"))).alias("b"))
    return rounded(best.select("b.threshold", "b.family", "b.accuracy"))


_FOLD = sql_hash_bucket(5, "id", seed=3)


@register(
    "m_fold_metrics", "M9",
    sql=f"""
    WITH s AS (SELECT *, {_FOLD} AS fold FROM p WHERE split = 'train'),
    m AS ({_METRICS_SQL.format(keys="family, fold", t="0.5", src="s")}),
    {_AUC_SQL.format(keys="family, fold", src="s")}
    SELECT m.family, m.fold, accuracy, f1, logloss, round(auc, 6) AS auc FROM m JOIN a ON m.family = a.family AND m.fold = a.fold""",
    fixtures=("p",),
)
def m_fold_metrics(spark, sf_dir):
    """M9: metrics per (family, fold) in one job: 20 groups, one aggregate + one ranking pass."""
    s = _oof(spark, sf_dir).withColumn("fold", C.hash_bucket(5, "id", seed=3))
    m = EV.binary_metrics(s, "p", "y", 0.5, by=["family", "fold"])
    a = EV.auc(s, "p", "y", by=["family", "fold"])
    return rounded(m.join(a, ["family", "fold"]).select("family", "fold", "accuracy", "f1", "logloss", "auc"))


@register(
    "f_fold_metric_stats", "F14",
    sql=f"""
    WITH s AS (SELECT *, {_FOLD} AS fold FROM p WHERE split = 'train'),
    m AS ({_EXACT_METRICS_SQL.format(keys="family, fold", t="0.5", src="s")})
    SELECT family, round(avg(accuracy), 6) AS acc_mean, round(stddev_pop(accuracy), 6) AS acc_std FROM m GROUP BY family""",
    fixtures=("p",),
)
def f_fold_metric_stats(spark, sf_dir):
    """mean and population std of the fold accuracies per family."""
    s = _oof(spark, sf_dir).withColumn("fold", C.hash_bucket(5, "id", seed=3))
    m = EV.binary_metrics(s, "p", "y", 0.5, by=["family", "fold"])
    return rounded(m.groupBy("family").agg(F.avg("accuracy").alias("acc_mean"), F.stddev_pop("accuracy").alias("acc_std")))


@register(
    "m_rule_audit", "M10",
    sql="""
    WITH j AS (SELECT p.family, p.p, p.y,
                      coalesce(w.flag = 'True', false) AND (coalesce(a1,0)+coalesce(a2,0)+coalesce(a3,0)+coalesce(a4,0)+coalesce(a5,0)) = 0 AS up,
                      coalesce(w.flag = 'True', false) AND (coalesce(a1,0)+coalesce(a2,0)+coalesce(a3,0)+coalesce(a4,0)+coalesce(a5,0)) > 0 AS down
               FROM p JOIN w ON p.id = w.id WHERE p.split = 'train'),
    r AS (SELECT family, y, CAST(p >= 0.5 AS INTEGER) AS base,
                 CAST(least(greatest(CASE WHEN up THEN p + 0.05 WHEN down THEN p - 0.1 ELSE p END, 1e-6), 1 - 1e-6) >= 0.5 AS INTEGER) AS new
          FROM j),
    a AS (SELECT family, CAST(sum(CAST(base <> new AS INTEGER)) AS BIGINT) AS flipped,
                 CAST(sum(CAST(base <> new AND new = y AS INTEGER)) AS BIGINT) AS correct_flip,
                 avg(CAST(base = y AS DOUBLE)) AS base_acc, avg(CAST(new = y AS DOUBLE)) AS rule_acc FROM r GROUP BY family)
    SELECT family, flipped, correct_flip, flipped - correct_flip AS wrong_flip, 2 * correct_flip - flipped AS delta_correct,
           round(base_acc, 6) AS base_acc, round(rule_acc, 6) AS rule_acc, round(rule_acc - base_acc, 6) AS delta_acc FROM a""",
    fixtures=("p",),
)
def m_rule_audit(spark, sf_dir):
    """A flag rule nudging scores (+.05 / -.10): flips, right and wrong flips, accuracy change."""
    w = wide(spark, sf_dir)
    p = predictions(spark, sf_dir, w).filter(F.col("split") == "train")
    flag = F.coalesce(F.col("flag") == "True", F.lit(False))
    total = C.row_sum(["a1", "a2", "a3", "a4", "a5"])
    j = p.join(w.select("id", "flag", "a1", "a2", "a3", "a4", "a5"), "id")
    return rounded(EV.rule_audit(j, "p", "y", flag & (total == 0), flag & (total > 0), by=["family"]))


@register(
    "m_prediction_diff", "M11",
    sql="""
    WITH a AS (SELECT id, CAST(p >= 0.5 AS INTEGER) AS la FROM p WHERE family = 'f2'),
    b AS (SELECT id, CAST(p >= 0.5 AS INTEGER) AS lb FROM p WHERE family = 'f3')
    SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(la <> lb AS INTEGER)) AS BIGINT) AS n_diff,
           CAST(count(*) - count(a.id) AS BIGINT) AS missing_a, CAST(count(*) - count(b.id) AS BIGINT) AS missing_b
    FROM a FULL OUTER JOIN b ON a.id = b.id""",
    fixtures=("p",),
)
def m_prediction_diff(spark, sf_dir):
    """Rows where two label sets differ, joined on id (no positional alignment)."""
    p = predictions(spark, sf_dir)
    a = p.filter(F.col("family") == "f2").select(F.col("id").alias("ida"), (F.col("p") >= 0.5).cast("int").alias("la"))
    b = p.filter(F.col("family") == "f3").select(F.col("id").alias("idb"), (F.col("p") >= 0.5).cast("int").alias("lb"))
    j = a.join(b, F.col("ida") == F.col("idb"), "full_outer")
    return j.agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("la") != F.col("lb")).cast("int")).cast("bigint").alias("n_diff"),
        (F.count(F.lit(1)) - F.count("ida")).alias("missing_a"), (F.count(F.lit(1)) - F.count("idb")).alias("missing_b"),
    )


@register(
    "m_calibration", "M13",
    sql="""SELECT family, CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS mean_y,
           CAST(count(*) AS BIGINT) AS n FROM p WHERE split = 'train' GROUP BY ALL""",
    fixtures=("p",),
)
def m_calibration(spark, sf_dir):
    """Calibration curve and probability histogram (10 bins)."""
    return rounded(EV.calibration(_oof(spark, sf_dir), "p", "y", 10, by=["family"]))


@register(
    "m_run_comparison", "M15",
    sql="""
    WITH m AS (""" + _EXACT_METRICS_SQL.format(keys="family, split", t="0.5", src="p") + """),
    l AS (SELECT family, split, 'accuracy' AS metric, accuracy AS value FROM m UNION ALL
          SELECT family, split, 'f1', f1 FROM m UNION ALL SELECT family, split, 'logloss', logloss FROM m)
    SELECT r.family, r.metric, round(r.value, 6) AS reported, round(e.value, 6) AS rerun, round(e.value - r.value, 6) AS delta
    FROM l r JOIN l e ON r.family = e.family AND r.metric = e.metric AND r.split = 'train' AND e.split = 'test'""",
    fixtures=("p",),
)
def m_run_comparison(spark, sf_dir):
    """Two runs side by side (train vs test split metrics as reported vs rerun) with the delta."""
    m = EV.binary_metrics(predictions(spark, sf_dir), "p", "y", 0.5, by=["family", "split"])
    long = m.unpivot(["family", "split"], ["accuracy", "f1", "logloss"], "metric", "value")
    r = long.filter(F.col("split") == "train").select("family", "metric", F.col("value").alias("reported"))
    e = long.filter(F.col("split") == "test").select("family", "metric", F.col("value").alias("rerun"))
    out = r.join(e, ["family", "metric"])
    return out.withColumn("delta", F.col("rerun") - F.col("reported")).transform(rounded)
