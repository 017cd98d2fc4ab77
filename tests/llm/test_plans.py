"""Plans of the text queries: no join that compares all with all, and Python only where it may be."""

import pytest

from pulse.llm.queries import QUERIES

from .conftest import SMALL

NATIVE = {"op1_mix_sources", "op6_pii", "op12_chat_format"}


@pytest.mark.parametrize("name", [name for name in QUERIES if name != "pipeline"])
def test_no_cross_or_nested_loop_join(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
