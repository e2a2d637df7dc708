from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_agrees_with_its_sql(spark, name):
    sql = oracle_sql().get(name)
    if sql is None:
        assert queries()[name](spark, SF_DIR).count() > 0
    else:
        assert compare(spark, SF_DIR, queries()[name], sql) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    rows = entry(spark).orderBy("prioridad").limit(3).collect()
    assert [(r.cod_cliente, r.prioridad, r.margen_porcentual) for r in rows] == [
        ("70", 1, 0.649311), ("140", 2, None), ("120", 3, None),
    ]
    assert entry(spark).count() == 112
