import duckdb
import pytest

import __spark_entry__ as ent
from dimsmith.llm.oracle import SQL

from .conftest import SF


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(session, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ent.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    got = ent.queries()[name](session, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, cur.fetchall()))
