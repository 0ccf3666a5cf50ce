"""Readers of entity tables and prediction frames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_pair_csv(spark: SparkSession, train_path: str, test_path: str, schema: StructType) -> DataFrame:
    """A1: headered CSV train/test pair with a declared schema, one frame with ``split``.

    Empty strings read as null (``nullValue`` is the empty string).  The test
    file has no label column, so it is read with the schema minus the label
    and the union fills the label with null.
    """
    test_schema = StructType([f for f in schema.fields if f.name in _header(spark, test_path)])
    train = spark.read.schema(schema).option("header", True).csv(train_path)
    test = spark.read.schema(test_schema).option("header", True).csv(test_path)
    return total_data(train, test)


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).limit(0).columns


def pick_source(spark: SparkSession, candidates: Sequence[tuple[str, str]], label: str, fmt: str = "parquet") -> tuple[str, str]:
    """A2: first (train, test) pair whose train has ``label`` and whose test lacks it.

    Only schemas are read (no data).
    """
    for train_path, test_path in candidates:
        try:
            tr = spark.read.format(fmt).load(train_path).limit(0).columns
            te = spark.read.format(fmt).load(test_path).limit(0).columns
        except Exception:  # noqa: BLE001 - a missing candidate is skipped
            continue
        if label in tr and label not in te:
            return train_path, test_path
    raise FileNotFoundError(f"no candidate with label {label!r} in train only")


def read_unlabelled(spark: SparkSession, path: str, label: str, fmt: str = "parquet") -> DataFrame:
    """A3: unlabelled scan; missing path, a label column or an empty table are errors."""
    df = spark.read.format(fmt).load(path)
    return check_unlabelled(df, label)


def check_unlabelled(df: DataFrame, label: str) -> DataFrame:
    if label in df.columns:
        raise ValueError(f"unlabelled table carries the label column {label!r}")
    if df.isEmpty():
        raise ValueError("unlabelled table is empty")
    return df


def total_data(train: DataFrame, test: DataFrame, split: str = "split") -> DataFrame:
    """A4: labelled ∪ unlabelled by name; the test label is null, ``split`` tags the origin."""
    a = train.withColumn(split, F.lit("train")) if split not in train.columns else train
    b = test.withColumn(split, F.lit("test")) if split not in test.columns else test
    return a.unionByName(b, allowMissingColumns=True)


def prediction_frame(df: DataFrame, id_col: str = "id", proba: str = "y_proba", blend: str = "y_proba_blend") -> DataFrame:
    """A5: prediction frame with the blended column preferred when present."""
    p = F.coalesce(F.col(blend), F.col(proba)) if blend in df.columns else F.col(proba)
    keep = [c for c in df.columns if c not in (proba, blend)]
    return df.select(*keep, p.alias(proba))


@dataclass
class CommonFrame:
    """A stored common frame: its rows, feature and fold columns, and the level table (or None)."""

    rows: DataFrame
    features: list[str]
    folds: list[str]
    levels: DataFrame | None


def load_common(spark: SparkSession, path: str, version: int, id_col: str = "id", label: str | None = None) -> CommonFrame:
    """The unit of ``sinks.store_common``, its columns in the stored order and of the stored types.

    Another version, rows that lack a described column, a null or repeated id, or a feature that is the id or the
    label raise; columns that are not described are left out.
    """
    spec = spark.read.parquet(f"{path}/spec").orderBy("place").collect()  # a row per column
    if not spec or any(r["version"] != version for r in spec):
        raise ValueError(f"{path} has version {spec[0]['version'] if spec else None}, not {version}")
    rows = spark.read.parquet(f"{path}/rows")
    absent = [r["column_name"] for r in spec if r["column_name"] not in rows.columns]
    if absent:
        raise ValueError(f"the stored rows lack {absent}")
    rows = rows.select(*[F.col(r["column_name"]).cast(r["kind"]).alias(r["column_name"]) for r in spec])
    features = [r["column_name"] for r in spec if r["feature"]]
    if leaked := [c for c in features if c in (id_col, label)]:
        raise ValueError(f"{leaked} can't be features")
    ids = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col(id_col).isNull() | (F.col("n") > 1)).alias("bad")).first()["bad"]
    if ids:
        raise ValueError(f"{ids} ids are null or repeated")
    levels = spark.read.parquet(f"{path}/levels") if spec[0]["has_levels"] else None
    return CommonFrame(rows, features, [r["column_name"] for r in spec if r["fold"]], levels)
