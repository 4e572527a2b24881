"""Every registered query against its SQL in a second engine."""

import pytest
from compare import differences, duck
from conftest import SF_DIR
from stintwise.registry.oracle import ORACLE
from stintwise.registry.queries import REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_only_the_model_lacks_sql():
    assert set(REGISTRY) - set(ORACLE) == {"ml_metrics", "ml_importance", "ml_predictions"}
    assert set(ORACLE) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(REGISTRY[name](spark, SF_DIR), con, ORACLE[name]) == []
