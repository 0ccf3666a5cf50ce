"""Projection, cleaning, type coercion and key parsing.

All operators are single projections over the input: no shuffle, and the
expressions are built-ins so the whole step is one codegen stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C


def string_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def clean_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """B1: trim every string column; blank strings become null (one select)."""
    targets = set(columns if columns is not None else string_columns(df))
    return df.select(*[C.blank_to_null(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def normalize_booleans(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """B2: boolean-like columns to "True"/"False"/null; numeric columns by value."""
    numeric = {c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")}
    return df.withColumns({c: C.bool_like(c, numeric=c in numeric) for c in columns})


def coerce_booleans_strict(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only true/false map (to 1.0/0.0); anything else null."""
    return df.withColumns({c: C.bool_strict(c) for c in columns})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bad values become null instead of raising (``try_cast``)."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def coerce_label(df: DataFrame, label: str) -> DataFrame:
    """Label to int 0/1; anything outside {0, 1, true, false} raises."""
    s = F.lower(F.trim(F.col(label).cast("string")))
    val = (
        F.when(s.isin("1", "1.0", "true"), F.lit(1))
        .when(s.isin("0", "0.0", "false"), F.lit(0))
        .otherwise(F.raise_error(F.concat(F.lit(f"label {label} outside 0/1: "), F.coalesce(s, F.lit("null")))))
    )
    return df.withColumn(label, val.cast("int"))


def coerce_predictions(df: DataFrame, column: str) -> DataFrame:
    """Predictions to boolean; bool, numeric 0/1 or "True"/"False" text accepted."""
    s = F.trim(F.col(column).cast("string"))
    val = (
        F.when(F.lower(s).isin("true", "1", "1.0"), F.lit(True))
        .when(F.lower(s).isin("false", "0", "0.0"), F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit(f"prediction {column} not boolean: "), F.coalesce(s, F.lit("null")))))
    )
    return df.withColumn(column, val)


def dedupe(names: Iterable[str]) -> list[str]:
    """Order-preserving de-duplication of column names."""
    seen: set[str] = set()
    return [n for n in names if not (n in seen or seen.add(n))]


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*[c for c in columns if c in df.columns])


def with_id_parts(df: DataFrame, id_col: str, group: str = "group_id", member: str = "member_no_id") -> DataFrame:
    """``gggg_pp`` -> group string and member int."""
    g, m = C.split_id(id_col)
    return df.withColumns({group: g, member: m})


def with_code_parts(df: DataFrame, code: str, names: Sequence[str] = ("deck", "num", "side")) -> DataFrame:
    """``deck/num/side`` -> three columns (number as double)."""
    d, n, s = C.split_code(code)
    return df.withColumns(dict(zip(names, (d, n, s))))


def with_last_token(df: DataFrame, source: str, name: str = "surname") -> DataFrame:
    """C4: last whitespace token of a text column."""
    return df.withColumn(name, C.last_token(source))
