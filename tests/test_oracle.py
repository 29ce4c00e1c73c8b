"""Every registered query against its reference SQL on the small data."""

import pytest
from compare import connection, differences
from conftest import SF_SMALL

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# Model fits take long on any data; one of each kind is tried in test_scoring.
SLOW = {"train_gbt", "train_xgboost_alias", "train_mlp", "train_random_forest", "train_logistic", "blended_models"}


@pytest.fixture(scope="module")
def duck():
    con = connection(SF_SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_matches_reference_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_SMALL), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.columns and df.count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["cell", "avg_label", "cell_income", "n_clients", "potential"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
