"""Helpers shared by the catalog modules.

Oracle hygiene (SURVEY §7.5): doubles are rounded to 6 decimals on both
engines with the same formula, ``floor(x * 1e6 + 0.5) / 1e6``.  Built-in
``round`` differs between the engines at exact decimal ties (Spark rounds the
exact binary value, DuckDB the scaled product), and such ties are common in
means of decimal data; one formula evaluated with the same IEEE operations
gives the same double on both sides.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1_000_000.0


def round6(c: Column) -> Column:
    return F.floor(c.cast("double") * SCALE + 0.5) / SCALE


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (oracle hygiene, SURVEY §7.5)."""
    return df.select(
        *[round6(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


def sql_round(expr: str, alias: str, digits: int = 6) -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * {SCALE} + 0.5) / {SCALE}) AS {alias}"


_ROUND = re.compile(r"\bround\(", re.IGNORECASE)


def unify_round(sql: str) -> str:
    """Rewrite every ``round(expr, 6)`` of an oracle text into the shared formula."""
    out, pos = [], 0
    while True:
        m = _ROUND.search(sql, pos)
        if not m:
            out.append(sql[pos:])
            return "".join(out)
        start = m.end()
        depth, i, comma = 1, start, None
        while depth:
            ch = sql[i]
            if ch in "([":
                depth += 1
            elif ch in ")]":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = i
            i += 1
        args_end = i - 1
        if comma is None or sql[comma + 1:args_end].strip() != "6":
            out.append(sql[pos:m.end()])
            pos = m.end()
            continue
        inner = unify_round(sql[start:comma])
        out.append(sql[pos:m.start()])
        out.append(f"(floor(CAST({inner} AS DOUBLE) * {SCALE} + 0.5) / {SCALE})")
        pos = args_end + 1
