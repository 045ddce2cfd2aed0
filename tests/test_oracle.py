"""Every registered query against its DuckDB oracle (the driver's check), at sf0.001."""

import pytest

import __spark_entry__ as E
from sf_dirs import SF_SMALL
from oracle_compare import compare, duck
from tickflow import oracle
from tickflow.queries import QUERIES

NAMES = sorted(QUERIES)
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(SQL)
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL.get(name), con)
    assert r["status"] == "ok", r


def test_entry_has_every_query(spark):
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "range_pct" in df.columns


SPARK_TO_DUCK = {"string": {"VARCHAR"}, "bigint": {"BIGINT"}, "int": {"INTEGER"},
                 "double": {"DOUBLE"}, "timestamp_ntz": {"TIMESTAMP"}, "boolean": {"BOOLEAN"},
                 "date": {"DATE"}}


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("stream")])
def test_column_types_match_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(SQL[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for col, t in sdf.dtypes:
        assert duck_types.get(col) in SPARK_TO_DUCK.get(t, {t}), (name, col, t, duck_types.get(col))
