import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMOKE
from tessera.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "id" in df.columns and df.count() > 0


def test_every_query_has_a_callable_and_known_oracles():
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 150
    assert set(sql) <= set(qs)


@pytest.mark.parametrize("name", ["d_common_frame", "j_target_oof", "m_auc", "g_percent_rank", "k_stratified_group_kfold", "n_weight_grid"])
def test_oracle_matches_at_smoke_scale(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    sdf = E.queries()[name](spark, SMOKE)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    srows = [tuple(r) for r in sdf.collect()]

    def norm(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows)

    assert sorted(sdf.columns) == sorted(ocols)
    assert norm(sdf.columns, srows) == norm(ocols, orows)
