"""Shared pieces of the oracle SQL and their Spark twins.

``keyed(w)`` / ``WK`` add the parsed keys of fixture W (group, member,
surname, deck, number, side, total) so that catalog queries start from the
same derived columns on both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.sources.fixtures import AMOUNTS

SURNAME_SQL = "CASE WHEN trim(name) = '' THEN NULL ELSE regexp_split_to_array(trim(name), '\\s+')[-1] END"
SIDE_SQL = "CASE WHEN len(string_split(code, '/')) >= 3 THEN array_to_string(string_split(code, '/')[3:], '/') END"
TOTAL_SQL = " + ".join(f"coalesce({a}, 0.0)" for a in AMOUNTS)

WK = f"""wk AS (
  SELECT *, split_part(id, '_', 1) AS group_id,
         TRY_CAST(CASE WHEN strpos(id, '_') > 0 THEN substr(id, strpos(id, '_') + 1) END AS INTEGER) AS member,
         {SURNAME_SQL} AS surname, split_part(code, '/', 1) AS deck,
         TRY_CAST(nullif(split_part(code, '/', 2), '') AS DOUBLE) AS num, {SIDE_SQL} AS side,
         {TOTAL_SQL} AS total
  FROM w)"""


def keyed(w: DataFrame) -> DataFrame:
    g, m = C.split_id("id")
    d, n, s = C.split_code("code")
    return w.withColumns({
        "group_id": g, "member": m, "surname": C.last_token("name"), "deck": d, "num": n, "side": s,
        "total": C.row_sum(AMOUNTS),
    })


def with_wk(sql: str) -> str:
    """Prefix a query over ``wk`` with the WK CTE (fixture CTEs are added by the registry)."""
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {WK},\n{body[5:]}"
    return f"WITH {WK}\n{body}"


def sql_hash_int(*cols: str, seed: int = 0) -> str:
    """Twin of :func:`columns.hash_bucket`'s integer: first 15 hex digits of md5 as BIGINT."""
    key = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + f", '{seed}')"
    return f"CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT)"


def sql_hash_bucket(k: int, *cols: str, seed: int = 0) -> str:
    return f"CAST({sql_hash_int(*cols, seed=seed)} % {k} AS INTEGER)"


def sql_hash_uniform(*cols: str, seed: int = 0) -> str:
    return f"({sql_hash_int(*cols, seed=seed)} / {float(16 ** 15)})"


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def total_col():
    return C.row_sum(AMOUNTS)


__all__ = ["WK", "keyed", "with_wk", "sql_hash_bucket", "sql_hash_uniform", "sql_hash_int", "r6", "F"]
