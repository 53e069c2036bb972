"""Every registered query against its SQL answer on the smallest tables, and its plan."""

import pytest

from conformance.check import compare, connect
from conformance.oracle import statements
from conformance.queries import QUERIES

from rows import plan

SMALL = "/root/testdata/sf0.001"
ANSWERS = statements()
# per-row Python and joins of everything with everything
UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    text = plan(df)
    for word in UNWANTED:
        assert word not in text
    assert compare(df, duck, ANSWERS[name]) is None


def test_days_add_up_to_silver(spark):
    total = QUERIES["gold_city_yearly_summary"](spark, SMALL).agg({"days": "sum"}).first()[0]
    assert total == QUERIES["silver_weather_cleaned"](spark, SMALL).count()
