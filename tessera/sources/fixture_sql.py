"""DuckDB text of the fixtures, for the oracle side of every check.

``with_fixtures(sql, "w", "p")`` prepends the CTEs a query needs, so an
oracle query reads the same base tables as the Spark query.
"""

from __future__ import annotations

from tessera.sources.fixtures import AMOUNTS, EVENT_TYPES, NULL_SLOTS


def _nulled(expr: str, slot: int) -> str:
    return (
        f"CASE WHEN (l_orderkey*7 + l_linenumber*13 + l_partkey*3 + {slot}) % 50 = 0 "
        f"THEN NULL ELSE {expr} END"
    )


_RAW = {
    "home": "r_name",
    "dest": "p_type",
    "vip": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'True' ELSE 'False' END",
    "flag": "CASE WHEN l_tax = 0 THEN 'True' ELSE 'False' END",
    "code": "p_type || '/' || CAST(p_size AS VARCHAR) || '/' || l_linestatus",
    "age": "CAST(floor(c_acctbal / 98) AS DOUBLE)",
    "a1": "CAST(CASE WHEN l_tax = 0 THEN 0.0 ELSE l_quantity END AS DOUBLE)",
    "a2": "CAST(CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice END AS DOUBLE)",
    "a3": "CAST(CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice * l_discount END AS DOUBLE)",
    "a4": "CAST(CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice * l_tax END AS DOUBLE)",
    "a5": "CAST(CASE WHEN l_tax = 0 THEN 0.0 ELSE l_quantity * l_tax END AS DOUBLE)",
    "name": "p_name",
}

W_SQL = f"""
SELECT member_no,
       CAST(l_orderkey AS VARCHAR) || '_' || CAST(member_no AS VARCHAR) AS id,
       {", ".join(f"{_nulled(_RAW[c], s)} AS {c}" for c, s in NULL_SLOTS.items())},
       CAST(l_returnflag = 'R' AS INTEGER) AS y,
       CASE WHEN l_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split
FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
         l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS INTEGER) AS member_no
  FROM lineitem
) li
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
"""

E_SQL = f"""
SELECT user_id, CAST(ts AS DATE) AS day,
       {", ".join(f"sum(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in EVENT_TYPES)}
FROM events GROUP BY user_id, CAST(ts AS DATE)
"""

P_SQL = """
SELECT id, split, y, 'f' || CAST(fam AS VARCHAR) AS family,
       CASE WHEN fam = 1 THEN least(p0 + y * 0.2, 0.999) ELSE p0 END AS p
FROM (
  SELECT id, split, y, fam,
         ((CAST(split_part(id, '_', 1) AS BIGINT) * 7919 + member_no * 104729 + fam * 1299709) % 10007 + 0.5)
           / 10007.0 AS p0
  FROM w CROSS JOIN (VALUES (1), (2), (3), (4)) fams(fam)
) t
"""

D_SQL = """
SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

_FIXTURES = {"w": W_SQL, "e": E_SQL, "p": P_SQL, "d": D_SQL}
_DEPENDS = {"p": ["w"]}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with ``WITH`` CTEs for the named fixtures (and their inputs)."""
    ordered: list[str] = []
    for n in names:
        for dep in _DEPENDS.get(n, []):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    ctes = ",\n".join(f"{n} AS ({_FIXTURES[n]})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


__all__ = ["W_SQL", "E_SQL", "P_SQL", "D_SQL", "with_fixtures", "AMOUNTS"]
