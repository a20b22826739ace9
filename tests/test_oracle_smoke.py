"""Every registered workload runs at sf0.001 and agrees with its DuckDB statement."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_all_workloads_match_oracle(spark):
    import duckdb
    import __spark_entry__ as E
    from trueform.workloads import QUERIES
    from tools.oracle_check import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, sqls = {n: q for n, q in E.queries().items() if n in QUERIES}, E.oracle_sql()
    bad = []
    for name, fn in sorted(qs.items()):
        df = fn(spark, SF)
        s_rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            continue
        res = con.execute(sqls[name])
        d_cols = [d[0] for d in res.description]
        if rows_of(df.columns, s_rows) != rows_of(d_cols, res.fetchall()):
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["event_id", "event_type", "user_id", "day", "value"]
    assert df.count() >= 0
