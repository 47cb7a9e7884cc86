import duckdb
import pytest

import __spark_entry__ as ent
from dimsmith.plans.catalog import catalog
from scripts.verify_oracle import TABLES, digest, duck_type_of

from conftest import SF001


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "__is_latest" in df.columns


def test_every_catalogue_query_has_an_oracle():
    """The training-data queries (registered where installed) have tests of their own."""
    assert set(catalog()) == set(catalog()) & set(ent.oracle_sql())
    assert set(catalog()) <= set(ent.queries()) and set(ent.oracle_sql()) <= set(ent.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog()))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ent.oracle_sql()[name])
    assert {f.name: duck_type_of(f.dataType.simpleString()) for f in df.schema} == \
        dict(zip(rel.columns, [str(t) for t in rel.types]))
    cur = duck.execute(ent.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(dcols, drows)
