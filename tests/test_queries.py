"""Every query against its SQL on the smallest tables."""

import pytest

from checks.compare import connect, difference
from checks.sql import ORACLE
from frostline.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, small, name):
    ours = QUERIES[name](spark, small).toPandas()
    theirs = con.execute(ORACLE[name]).df()
    assert difference(ours, theirs) is None


def test_ordered_queries_keep_their_order(spark, con, small):
    ordered = {
        "chart_leaderboard": "container_id",
        "chart_matrix": "container",
        "audit_trail": "record_id",
        "alert_feed": "record_id",
        "chart_temp": "container_id",
        "filter_values_risk": "risk_category",
    }
    for name, column in ordered.items():
        ours = [r[column] for r in QUERIES[name](spark, small).select(column).collect()]
        assert ours == con.execute(ORACLE[name]).df()[column].tolist(), name
