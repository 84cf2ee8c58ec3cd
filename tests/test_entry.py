import os

import pytest

import __spark_entry__ as entry_module


def test_every_oracle_has_a_query():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) > 85 and len(oracles) > 80


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
def test_entry_runs(spark):
    assert entry_module.entry(spark).count() == 84
