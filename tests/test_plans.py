"""Plan properties that must hold at any scale (checked on the smallest tables)."""

import re

import pytest

from support import SF_SMALL
from lectern.plans.registry import QUERIES

# these run a write step before their result is planned; tools/plan_audit.py audits them
WRITERS = {"jsonl_roundtrip", "exam_records", "validate_records", "saved_images", "build_records", "build_problems", "build_images"}
HAZARDS = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|SinglePartition|BatchEvalPython|ArrowEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_plan_hazards(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not HAZARDS.search(plan), HAZARDS.search(plan).group(0)
    assert "RoundRobinPartitioning" not in plan


def test_line_windows_are_chunked(spark):
    plan = _plan(QUERIES["segment_lines"](spark, SF_SMALL))
    specs = re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", plan)
    over_lines = [s for s in specs if "line_no" in s]
    assert over_lines
    # every window ordered by line is partitioned by the chunk as well as the document
    for spec in over_lines:
        assert "_chunk" in spec, spec
