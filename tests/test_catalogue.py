"""Every query of the linked-read engine against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

from linkweave.plans import catalogue

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def _rows(columns, rows):
    place = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in place) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_parity(spark, oracle, name):
    found = catalogue.queries()[name](spark, SMALL)
    want = oracle.sql(catalogue.oracle_sql()[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert _rows(found.columns, [tuple(r) for r in found.collect()]) == _rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
