"""Every registered query against its SQL at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SLOW = {"m3_stage1", "m4_stage2", "m5_oof", "m15_score_open"}  # need more rows than the smallest scale has


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", [q for q in queries() if q not in SLOW])
def test_query(spark, con, sf, name):
    assert compare.compare(spark, con, sf, name).startswith(("ok", "rows only"))


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", oracle_sql())
def test_every_sql_is_prepared(con, name):
    con.execute(f"EXPLAIN {oracle_sql()[name]}")


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
