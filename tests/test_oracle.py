"""Every query with an oracle against DuckDB; all others run and return rows."""

import pytest
from support import SF
from oracle import differences, duck, duck_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries

FNS, SQLS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_oracle(spark, con, name):
    assert differences(spark_rows(FNS[name](spark, SF)), duck_rows(con, SQLS[name])) == []


@pytest.mark.parametrize("name", sorted(set(FNS) - set(SQLS)))
def test_runs(spark, name):
    assert FNS[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(FNS)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert {"series", "date", "vol_up", "realized_vol_lag_1", "park_vol_ma_20", "dow"} <= set(df.columns)
    assert "realized_vol" not in df.columns
