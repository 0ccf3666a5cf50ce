"""Sinks.

Writers are distributed (each task writes its part); the submission keeps
the test order through an explicit ``row_no`` sort, never a positional
assumption.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.core import write_rows


def submission_frame(df: DataFrame, id_col: str, proba: str, threshold: float = 0.5, label: str = "label",
                     keep: Sequence[str] = ()) -> DataFrame:
    """``id, label(bool)`` with ``p >= threshold``; ``keep`` carries the order key for the writer."""
    return df.select(F.col(id_col), *keep, (F.col(proba) >= F.lit(threshold)).alias(label))


def write_submission(df: DataFrame, path: str, order_cols: Sequence[str] = (), single_file: bool = False) -> None:
    """CSV in the order of ``order_cols`` (a unique key; its columns are not written), in range-ordered part files.

    ``single_file`` makes one task write everything, so it is for small outputs only.
    """
    out = df.orderBy(*order_cols) if order_cols else df
    if single_file:
        out = out.coalesce(1)
    out.drop(*order_cols).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def write_frame(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """OOF / test probabilities (``id, y_true, proba, pred, fold``)."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)


def preview(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """A10: first ``n`` rows in key order (the limit is the feature)."""
    return df.orderBy(key).limit(n)


def write_json_report(report: DataFrame, path: str) -> None:
    """Long report rows ``(section, metric, value)`` as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)


#: Layout of a stored common frame; a reader asks for the one it knows.
COMMON_VERSION = 1


def store_common(
    df: DataFrame, path: str, features: Sequence[str], folds: Sequence[str] = (), levels: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    version: int = COMMON_VERSION,
) -> None:
    """One unit on disk: the rows, a level table (``column_name, level, idx``), and a description of both.

    ``features`` and ``folds`` are columns of ``df``; ``levels`` may be a function of the rows, which gets the stored ones, so that ``df`` is
    computed once.  The description is written last, so a unit without it is not one.
    """
    absent = [c for c in [*features, *folds] if c not in df.columns]
    if absent:
        raise ValueError(f"the frame lacks {absent}")
    write_rows(df, f"{path}/rows")
    if callable(levels):
        levels = levels(df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows"))
    if levels is not None:
        levels.write.mode("overwrite").parquet(f"{path}/levels")
    kinds = dict(df.dtypes)
    columns = [(i, c, kinds[c], c in features, c in folds) for i, c in enumerate(df.columns)]
    spec = df.sparkSession.createDataFrame(columns, "place int, column_name string, kind string, feature boolean, fold boolean")  # a row per column
    spec = spec.withColumns({"version": F.lit(version), "has_levels": F.lit(levels is not None)})
    spec.coalesce(1).write.mode("overwrite").parquet(f"{path}/spec")
