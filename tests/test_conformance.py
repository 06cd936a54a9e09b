"""The registered queries against their SQL on the smallest tables.

Whole runs over all months take minutes and are tested in ``test_runs``; ``python -m conformance.compare`` runs their queries too.
"""

from pathlib import Path

import pytest

import __spark_entry__
from conformance.compare import connect, difference
from conformance.oracle import all_sql
from conformance.queries import all_queries

SF = "/root/testdata/sf0.001"
WHOLE_RUNS = {"run_months_state", "audited_catch_up"}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert all_queries().keys() == all_sql().keys()


@pytest.mark.parametrize("name", sorted(all_queries().keys() - WHOLE_RUNS))
def test_query(spark, duck, name):
    assert difference(all_queries()[name](spark, SF), duck, all_sql()[name]) == ""


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
