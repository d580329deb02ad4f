"""Every registered query against its SQL twin (smallest supplied tables)."""

import os

import oracle
import pytest
from tributary.plans.catalog import QUERIES
from tributary.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODELS = {"oof_leafwise", "null_selection"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_only_models_lack_a_twin():
    assert set(QUERIES) - set(ORACLE) == MODELS and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() == 150 and df.columns[0] == "c_custkey"
