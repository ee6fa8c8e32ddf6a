"""The operators in built-in functions keep Python, cross joins and windows over everything out of their plans."""

import re

import pytest

from railgauge.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op3_preferences", "op4_fingerprints"])
def test_native_plans(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for banned in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
