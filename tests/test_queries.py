"""Registered queries against their SQL oracles, on the smallest scale."""

import duckdb
import pytest

from spotspark import queries as library

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM '{DIR}/events.parquet'")
    return c


def plain(rows):
    return sorted(tuple(f"{x:.5f}".replace("-0.00000", "0.00000") if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(library.ORACLES))
def test_query_equals_its_oracle(spark, con, name):
    df = library.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    sql = con.sql(library.ORACLES[name])
    assert columns == sorted(sql.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert plain(map(tuple, df.select(*columns).collect())) == plain(con.sql(f"SELECT {quoted} FROM ({library.ORACLES[name]})").fetchall())
