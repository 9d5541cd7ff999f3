import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

# These train models or run streams; test_plans covers the same code on a smaller table.
SLOW = {"m9_parameter_search", "m10_cross_validation", "m14_training_run", "v13_learning_curve", "n6_stream_summary",
        "n8_message_scores", "m2_decision_tree", "m3_random_forest", "m4_boosted_trees", "m5_boosted_trees_deep",
        "v12_feature_importance", "s7_champion_metadata"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"category", "n", "rate_pct", "overall_pct"} == set(rows[0].asDict())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, con, sf, name):
    fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, sf).count() > 0
    else:
        assert compare(spark, con, fn, sql, sf) is None
