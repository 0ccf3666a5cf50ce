"""Queries of SURVEY §2.A (scans, sources, sinks).

Files are written under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster) from data Spark derives from the given tables, then read
back through the readers; every writer is distributed except the
single-file outputs the reference produces (a submission, a report).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tessera.functions import columns as C
from tessera.operators.core import MATERIALIZED, materialize
from tessera.operators.encode import level_index
from tessera.operators.profile import null_counts
from tessera.plans import common_frame as CF
from tessera.plans.common_frame_sql import COMMON_FRAME_SQL
from tessera.plans.registry import register
from tessera.plans.sqlparts import sql_hash_bucket
from tessera.plans.util import rounded
from tessera.session import ensure_checkpoint_dir
from tessera.sources import readers as RD
from tessera.sources import sinks as SK
from tessera.sources.fixtures import AMOUNTS, predictions, wide

W_SCHEMA = StructType(
    [StructField("member_no", IntegerType()), StructField("id", StringType())]
    + [StructField(c, StringType()) for c in ("home", "dest", "vip", "flag", "code")]
    + [StructField("age", DoubleType())] + [StructField(a, DoubleType()) for a in AMOUNTS]
    + [StructField("name", StringType()), StructField("y", IntegerType())]
)
_COLS = [f.name for f in W_SCHEMA.fields]


def _scratch(spark, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    MATERIALIZED.append(path)  # removed with the other scratch tables
    return path


def _write_pair(spark, sf_dir, fmt: str):
    w = wide(spark, sf_dir)
    base = _scratch(spark, f"pair-{fmt}")
    train_path, test_path = f"{base}/train", f"{base}/test"
    w.filter(F.col("split") == "train").select(*_COLS).write.format(fmt).option("header", True).save(train_path)
    w.filter(F.col("split") == "test").select(*[c for c in _COLS if c != "y"]).write.format(fmt).option("header", True).save(test_path)
    return train_path, test_path


_PAIR_SQL = ("SELECT " + ", ".join(c for c in _COLS if c != "y")
             + ", CASE WHEN split = 'train' THEN y END AS y, split FROM w")


@register("a_csv_pair", "A1/A4", sql=_PAIR_SQL)
def a_csv_pair(spark, sf_dir):
    """A1/A4: headered CSV train/test pair read with a declared schema, unioned by name (test label null)."""
    train_path, test_path = _write_pair(spark, sf_dir, "csv")
    return rounded(RD.read_pair_csv(spark, train_path, test_path, W_SCHEMA))


@register("a_pick_source", "A2")
def a_pick_source(spark, sf_dir):
    """A2: the first candidate pair whose train has the label and whose test lacks it (schemas only)."""
    train_path, test_path = _write_pair(spark, sf_dir, "parquet")
    cands = [(test_path, train_path), (_scratch(spark, "missing"), test_path), (train_path, test_path)]
    tr, te = RD.pick_source(spark, cands, "y")
    return spark.read.parquet(tr).groupBy().agg(F.count(F.lit(1)).alias("train_rows"), F.count("y").alias("labelled"))


@register(
    "a_unlabelled_scan", "A3",
    sql="SELECT " + ", ".join(c for c in _COLS if c != "y") + " FROM w WHERE split = 'test'",
)
def a_unlabelled_scan(spark, sf_dir):
    """A3: unlabelled table read with its contract (no label column, not empty)."""
    _, test_path = _write_pair(spark, sf_dir, "parquet")
    return rounded(RD.read_unlabelled(spark, test_path, "y"))


@register(
    "a_prediction_frame", "A5",
    sql="""SELECT id, round(coalesce(b, a), 6) AS y_proba FROM (
             SELECT id, max(CASE WHEN family = 'f1' THEN p END) AS a,
                    CASE WHEN max(CASE WHEN family = 'f1' THEN p END) >= 0.5
                         THEN (max(CASE WHEN family = 'f1' THEN p END) + max(CASE WHEN family = 'f2' THEN p END)) / 2 END AS b
             FROM p WHERE split = 'test' GROUP BY id) t""",
    fixtures=("p",),
)
def a_prediction_frame(spark, sf_dir):
    """A5: prediction frame with an optional blended column preferred where present."""
    p = predictions(spark, sf_dir).filter(F.col("split") == "test")
    wide_p = p.groupBy("id").pivot("family", ["f1", "f2"]).agg(F.max("p"))
    frame = wide_p.select(
        "id", F.col("f1").alias("y_proba"),
        F.when(F.col("f1") >= 0.5, (F.col("f1") + F.col("f2")) / 2).alias("y_proba_blend"),
    )
    path = _scratch(spark, "proba")
    SK.write_frame(frame, path)
    return rounded(RD.prediction_frame(spark.read.parquet(path)))


@register(
    "a_long_scores", "A6",
    sql="SELECT id, split, family, round(p, 6) AS p FROM p",
    fixtures=("p",),
)
def a_long_scores(spark, sf_dir):
    """Named score vectors kept as one keyed long table (family, split, id, p) in parquet."""
    path = _scratch(spark, "scores")
    predictions(spark, sf_dir).select("id", "split", "family", "p").write.partitionBy("family").parquet(path)
    return rounded(spark.read.parquet(path).select("id", "split", "family", "p"))


@register(
    "a_submission", "A8",
    sql="SELECT id, p >= 0.5 AS label FROM p WHERE family = 'f1' AND split = 'test'",
    fixtures=("p",),
)
def a_submission(spark, sf_dir):
    """Submission CSV (id, boolean label) written in test order (group, then member), read back."""
    p = predictions(spark, sf_dir).filter((F.col("family") == "f1") & (F.col("split") == "test"))
    order = {"group_no": C.split_id("id")[0].cast("bigint"), "member_no": C.split_id("id")[1].cast("bigint")}
    sub = SK.submission_frame(p.withColumns(order), "id", "p", keep=list(order))
    path = _scratch(spark, "submission")
    SK.write_submission(sub, path, order_cols=list(order))
    return spark.read.schema("id string, label boolean").option("header", True).csv(path)


@register("a_preview", "A10", sql="SELECT * REPLACE (" + ", ".join(
    f"round({c}, 6) AS {c}" for c in ["age", *AMOUNTS]) + ") FROM w ORDER BY id LIMIT 100")
def a_preview(spark, sf_dir):
    """A10: the first 100 rows in key order (the limit is the feature)."""
    return rounded(SK.preview(wide(spark, sf_dir), "id", 100))


@register("a_json_report", "A11")
def a_json_report(spark, sf_dir):
    """A long report written as JSON lines (one file) and read back."""
    rep = null_counts(wide(spark, sf_dir), ["home", "dest", "age", *AMOUNTS])
    path = _scratch(spark, "report")
    SK.write_json_report(rep.select(F.lit("nulls").alias("section"), F.col("column_name").alias("metric"),
                                    F.col("nulls").cast("double").alias("value")), path)
    return spark.read.schema("section string, metric string, value double").json(path)


_COMMON_FEATURES = ["age", "a1", "a2", "a3", "a4", "a5", "home", "dest", "vip", "flag", "deck", "num_bin", "group_size", "surname_freq"]


@register(
    "a_common_reload", "A7",
    sql=f"SELECT *, CASE WHEN split = 'train' THEN {sql_hash_bucket(5, 'id', seed=3)} END AS fold FROM ({COMMON_FRAME_SQL}) cf",
)
def a_common_reload(spark, sf_dir):
    """The common frame stored as one unit with its features, folds and levels, and read back with its version checked."""
    cf = rounded(CF.build(wide(spark, sf_dir)).select(*CF.OUTPUT_COLUMNS))
    cf = cf.withColumn("fold", F.when(F.col("split") == "train", C.hash_bucket(5, "id", seed=3)))
    path = _scratch(spark, "common")
    SK.store_common(cf, path, _COMMON_FEATURES, ["fold"], lambda rows: level_index(rows, ["home", "dest", "deck"]))
    return RD.load_common(spark, path, SK.COMMON_VERSION, label="y").rows


@register(
    "a_common_levels", "A7",
    sql="WITH cf0 AS MATERIALIZED (SELECT home, dest, deck FROM (" + COMMON_FRAME_SQL + ") cf) " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS level, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT {c} FROM cf0) {c}_levels" for c in ("home", "dest", "deck")),
)
def a_common_levels(spark, sf_dir):
    """The level table that the stored unit carries."""
    cf = CF.build(wide(spark, sf_dir)).select(*CF.OUTPUT_COLUMNS)
    path = _scratch(spark, "common")
    SK.store_common(cf, path, _COMMON_FEATURES, (), lambda rows: level_index(rows, ["home", "dest", "deck"]))
    return RD.load_common(spark, path, SK.COMMON_VERSION, label="y").levels
