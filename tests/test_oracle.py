"""Every registered query with SQL gives DuckDB's rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = entry.oracle_sql()


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    clean = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 5) + 0.0 if isinstance(v, float) else float(v) if isinstance(v, int) and not isinstance(v, bool) else v
    return sorted(names), sorted(str([clean(r[k]) for k in order]) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(SQL[name])
    wanted = rows([d[0] for d in cursor.description], cursor.fetchall())
    df = entry.queries()[name](spark, SF)
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    assert found[0] == wanted[0]
    assert len(found[1]) == len(wanted[1])
    assert found[1] == wanted[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
