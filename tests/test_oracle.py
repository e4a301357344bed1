"""Every registered query with a SQL twin equals DuckDB's answer (sf0.001)."""
import pytest

import __spark_entry__ as E
from sf_dirs import SF_SMALL
from lodestone.plans.queries import ORACLE_SQL, QUERIES
from scripts.check_oracle import TABLES, digest

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    r = duck.execute(SQL[name])
    ocols = [d[0] for d in r.description]
    orows = r.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_runs_or_has_oracle():
    assert set(SQL) <= set(E.queries())
    # of the queries outside the optional subpackage only forest fits have no twin
    rows_only = set(QUERIES) - set(ORACLE_SQL)
    assert rows_only <= {"ml_cv_results_quality", "ml_test_report_quality", "ml_pdp_forest_quality",
                         "ml_forest_orders", "ml_forest_fit_lineitem"}


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["l_returnflag", "n"]
    assert sum(r["n"] for r in rows) == 6000
