"""Every registered query with SQL gives the same rows as that SQL in DuckDB."""

import pytest

import catalog
import check

SMALL = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"
TRAINED = {"fit_models", "select_best", "learning_curve", "score_export", "model_coefficients", "curve_optimum"}  # the smallest tables have no complete training row


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLES) - TRAINED))
def test_matches_sql(spark, con, name):
    result, rows, _ = check.compare(spark, con, name, SMALL)
    assert result == "ok"


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_models_match_sql(spark, name):
    assert check.compare(spark, check.connect(MORE), name, MORE)[0] == "ok"


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0


def test_no_query_name_is_reserved():
    assert not [n for n in catalog.QUERIES if "pipeline" in n or n.startswith("op")]
