"""Every query against its SQL twin on the smallest tables."""

import check
import pytest

import __spark_entry__ as entry

#: Checked in test_models.py on a table where classes can be told apart.
SLOW = {
    "cross_validate", "random_forest", "logistic", "linear_svm", "rbf_svm",
    "gradient_boosting", "boosted_trees", "neural_net", "feature_importance",
    "coefficients", "score_postings", "compare_models",
}


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query(spark, sf, name):
    outcome = check.compare(spark, sf, entry.queries()[name], entry.oracle_sql().get(name))
    assert outcome.startswith(("ok (", "rows only")), outcome


def test_entry(spark):
    assert entry.entry(spark).count() == 2


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
