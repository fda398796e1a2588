"""How the queries put their inputs together."""

import pytest

import __spark_entry__ as entry

from .conftest import SMALL


@pytest.mark.parametrize("name", ["upload_csv", "reports_by_level", "count_report_levels"])
def test_parts_and_customers_do_not_go_through_the_driver(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [l_partkey") >= 1
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and ("p_partkey" in x or "c_custkey" in x)]


def test_shuffled_inputs_hold_the_same_rows(spark):
    from shelfcount_checks.inputs import Inputs

    plain = Inputs(spark, SMALL)
    for name in ("book", "planm", "package"):
        a, b = getattr(plain, name), getattr(plain.shuffled, name)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
