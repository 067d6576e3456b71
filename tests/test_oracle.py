"""Every registered job against its DuckDB oracle (the driver's gate).

Runs at sf0.001 to stay quick; ``python -m tests.oracle <sf_dir>`` runs the
same comparison at any scale.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from sluice.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

entry_module.queries()  # loads the registry
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_job_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_job_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLES.get(name), con)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "master_patient_lookup_table_unique_key" in df.columns
