"""Column expressions: cleaning, boolean parsing, key parsing, row-wise math.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing calls back into Python per row.
ANSI mode is on in Spark 4, so parsing uses ``try_cast`` / ``get`` /
``try_divide`` which give null instead of raising.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]
MISSING_TOKEN = "__MISSING__"
UNKNOWN = "Unknown"

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings (B1, C)

# Characters stripped from both ends of text values (ASCII whitespace).
WHITESPACE = " \t\n\r\x0b\x0c"


def blank_to_null(c: ColumnOrName) -> Column:
    """Trim surrounding whitespace; whitespace-only and empty strings become null.

    ``btrim`` with the whitespace set (no regular expression), evaluated once.
    """
    return F.nullif(F.btrim(col(c), F.lit(WHITESPACE)), F.lit(""))


def bool_like(c: ColumnOrName, numeric: bool = False) -> Column:
    """Normalise boolean-like values to "True"/"False"/null (B2).

    Strings: true/1/yes and false/0/no after trim+lower.  Numeric input:
    exactly 1.0 and 0.0.
    """
    if numeric:
        x = col(c).cast("double")
        return F.when(x == 1.0, "True").when(x == 0.0, "False").otherwise(F.lit(None).cast("string"))
    s = F.lower(F.trim(col(c).cast("string")))
    return (
        F.when(s.isin(*TRUE_WORDS), "True")
        .when(s.isin(*FALSE_WORDS), "False")
        .otherwise(F.lit(None).cast("string"))
    )


def bool_strict(c: ColumnOrName) -> Column:
    """Only the words true/false (any case) map; anything else null (B3), as 1/0."""
    s = F.lower(F.trim(col(c).cast("string")))
    return F.when(s == "true", F.lit(1.0)).when(s == "false", F.lit(0.0)).otherwise(F.lit(None).cast("double"))


def bool_bucket(c: ColumnOrName) -> Column:
    """True / False / Missing / Other class of a raw boolean-like value."""
    s = F.lower(F.trim(col(c).cast("string")))
    return (
        F.when(col(c).isNull() | (s == ""), "Missing")
        .when(s.isin("true", "1", "yes", "y"), "True")
        .when(s.isin("false", "0", "no", "n"), "False")
        .otherwise("Other")
    )


def split_id(c: ColumnOrName, sep: str = "_") -> tuple[Column, Column]:
    """``"0001_02"`` -> (group ``"0001"``, member ``2``); one split at most."""
    parts = F.split(col(c), sep, 2)
    return F.get(parts, 0), F.get(parts, 1).try_cast("int")


def split_code(c: ColumnOrName, sep: str = "/") -> tuple[Column, Column, Column]:
    """``"B/12/S"`` -> (deck, number as double, side); short codes give null."""
    parts = F.split(col(c), sep, 3)
    return F.get(parts, 0), F.get(parts, 1).try_cast("double"), F.get(parts, 2)


def last_token(c: ColumnOrName) -> Column:
    """Last whitespace-separated token (C4); null stays null."""
    tokens = F.split(F.trim(col(c)), r"\s+")
    return F.when(F.trim(col(c)) == "", F.lit(None).cast("string")).otherwise(F.element_at(tokens, -1))


def last_token_lower(c: ColumnOrName, default: str = "no_name") -> Column:
    """Lower-cased last token with a default for null."""
    return F.coalesce(F.lower(last_token(c)), F.lit(default))


def lookup_key(*cs: ColumnOrName) -> Column:
    """JSON list of the values with null as ``__MISSING__``."""
    return F.to_json(F.array(*[F.coalesce(col(c).cast("string"), F.lit(MISSING_TOKEN)) for c in cs]))


def interaction_key(*cs: ColumnOrName, unknown: str = UNKNOWN, sep: str = "_") -> Column:
    """``A_B`` with null parts as ``Unknown``."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit(unknown)) for c in cs])


# ---------------------------------------------------------------- row-wise

def row_sum(cs: Sequence[ColumnOrName], skip_null: bool = True) -> Column:
    """Sum across columns; skip-null (pandas default) or complete-case (null if any null)."""
    terms = [F.coalesce(col(c), F.lit(0.0)) if skip_null else col(c) for c in cs]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def row_count_positive(cs: Sequence[ColumnOrName]) -> Column:
    out = F.lit(0)
    for c in cs:
        out = out + F.coalesce((col(c) > 0).cast("int"), F.lit(0))
    return out


def row_count_null(cs: Sequence[ColumnOrName]) -> Column:
    out = F.lit(0)
    for c in cs:
        out = out + col(c).isNull().cast("int")
    return out


def row_mean(cs: Sequence[ColumnOrName]) -> Column:
    return row_sum(cs) / F.lit(float(len(cs)))


def row_std_pop(cs: Sequence[ColumnOrName]) -> Column:
    """Population std of the columns (nulls as 0, as after imputation)."""
    m = row_mean(cs)
    sq = None
    for c in cs:
        d = F.coalesce(col(c), F.lit(0.0)) - m
        sq = d * d if sq is None else sq + d * d
    return F.sqrt(sq / F.lit(float(len(cs))))


def row_max(cs: Sequence[ColumnOrName]) -> Column:
    return F.greatest(*[col(c) for c in cs])


def safe_ratio(num: ColumnOrName, den: ColumnOrName, default: float | None = 0.0) -> Column:
    """num / den with 0 (or ``default``) where the division is undefined."""
    r = F.try_divide(col(num), col(den))
    return r if default is None else F.coalesce(r, F.lit(default))


def log1p_clipped(c: ColumnOrName) -> Column:
    """log1p(max(x, 0))."""
    return F.log1p(F.greatest(col(c), F.lit(0.0)))


def r6(c: ColumnOrName) -> Column:
    """Round a double to 6 digits (oracle hygiene)."""
    return F.floor(col(c).cast("double") * 1_000_000.0 + 0.5) / 1_000_000.0


def hash_uniform(*cs: ColumnOrName, seed: int = 0) -> Column:
    """Deterministic number in [0, 1) from md5 of the key and a seed.

    The same text gives the same hex in DuckDB, so hash-based draws are
    oracle-comparable: ``conv(first 15 hex digits) / 16**15``.
    """
    key = F.concat_ws("|", *[col(c).cast("string") for c in cs], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint") / F.lit(float(16**15))


def hash_bucket(k: int, *cs: ColumnOrName, seed: int = 0) -> Column:
    """``pmod(hash(key, seed), k)`` with an md5-based hash (K3 bulk mode)."""
    key = F.concat_ws("|", *[col(c).cast("string") for c in cs], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint"), F.lit(k)).cast("int")


def hash_int(*cs: ColumnOrName, seed: int | str = 0) -> Column:
    """The 60-bit integer behind :func:`hash_uniform` and :func:`hash_bucket`."""
    key = F.concat_ws("|", *[col(c).cast("string") for c in cs], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def md5_key(*cs: ColumnOrName, seed: int = 0) -> Column:
    return F.md5(F.concat_ws("|", *[col(c).cast("string") for c in cs], F.lit(str(seed))))


def fixed_width_group(c: ColumnOrName) -> tuple[Column, Column]:
    """Group key by fixed width: all but the last 3 characters as a number, and the first 4 characters."""
    s = col(c)
    head = s.substr(F.lit(1), F.greatest(F.length(s) - 3, F.lit(0)))
    return head.try_cast("bigint").alias("group_num"), F.substring(s, 1, 4).alias("group_prefix")


def exact_sum(c: ColumnOrName, scale: int = 4) -> Column:
    """Sum of decimal data (amounts with at most ``scale`` decimals) as DECIMAL: exact, so
    the result does not depend on the order in which partial sums are combined."""
    return F.sum(col(c).cast(f"decimal(38,{scale})"))


def exact_mean(c: ColumnOrName, scale: int = 4) -> Column:
    """Mean of decimal data from an exact decimal sum (run-to-run deterministic)."""
    return exact_sum(c, scale).cast("double") / F.count(col(c))
