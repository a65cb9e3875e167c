"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01): same column names, same row count,
same multiset of rows with floats compared to 9 significant digits."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tripscope import registry
from tests.conftest import SF_SMALL
from tools.check_oracle import _rows
from tripscope.sources.tables import DRIVER_TABLES, table_path

SQL = registry.oracle_sql()
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    yield con
    con.close()


def test_contract():
    assert len(KEYS) == 53
    assert set(SQL) <= set(KEYS)
    assert set(KEYS) - set(SQL) == {"eda_schema"}
    assert set(KEYS) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["pu_borough", "do_borough", "trips"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    sdf = registry.queries()[key](spark, SF_SMALL)
    cols = sdf.columns
    rows = [tuple(r) for r in sdf.collect()]
    if key not in SQL:
        assert rows  # rows-only keys: schema / file inventory
        return
    res = duck.execute(SQL[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _rows(cols, rows, 9) == _rows(dcols, drows, 9)


def test_oracle_sql_uses_only_registered_views():
    for key, sql in SQL.items():
        low = sql.lower()
        assert "read_parquet" not in low and "/root/" not in low and "read_csv" not in low, key


def test_outputs_have_unique_plain_names(spark):
    for key in KEYS:
        cols = registry.queries()[key](spark, SF_SMALL).columns
        assert len(cols) == len(set(cols)), key
        assert all(c.replace("_", "").isalnum() for c in cols), (key, cols)
