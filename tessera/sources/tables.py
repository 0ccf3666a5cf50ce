"""Parquet table scans.

Every scan goes through :func:`table` so that column pruning reaches the
parquet reader (``ReadSchema`` shows only the selected columns) and filters
written later on the DataFrame are pushed into the scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table; when ``columns`` are given only they are read."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
