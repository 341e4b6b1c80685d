"""Plans that must hold at scale: few shuffles, pruned scans, no products, no Python."""

import contextlib
import io
import re

import pytest

from frostline.queries import QUERIES

STREAMS = [n for n in QUERIES if n.startswith("stream_")]
WRITERS = [n for n in QUERIES if n.startswith(("src_", "sink_", "mart_materialize"))]


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS + WRITERS])
def test_no_products_and_no_python(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert forbidden not in plan


def test_mart_shuffles_once(spark, small):
    plan = plan_of(QUERIES["spoilage_arbitrage"](spark, small))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2


def test_rolling_decision_shuffles_once(spark, small):
    plan = plan_of(QUERIES["rolling_decision"](spark, small))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_average_reads_only_what_it_needs(spark, small):
    schema = re.search(r"ReadSchema: (\S+)", plan_of(QUERIES["kpi_avg_humidity"](spark, small)))
    assert "event_type" not in schema.group(1) and "value" not in schema.group(1)
