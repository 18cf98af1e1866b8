"""Every registered query with SQL, against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as contract
from oracle import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(compare.SQL))
def test_query_equals_its_sql(spark, con, name):
    assert compare.difference(spark, con, name, FOLDER) is None


def test_contract(spark):
    assert contract.entry(spark).columns == ["user_id"] and contract.entry(spark).count() == 2
    own = {name for name in contract.queries() if name in compare.QUERIES}
    assert own - set(contract.oracle_sql()) == {"saved_model", "train_linear", "svm_grid", "train_gbt", "model_portfolio", "feature_importance", "score_users"}
    assert set(compare.SQL) <= set(contract.queries())
