"""Plan shapes that must hold at any scale."""

import re

import pytest
from conftest import SMALL

from changeflow.queries import QUERIES

# Only block totals and single-row totals may meet in one partition.
SMALL_BELOW_SINGLE = ("_total", "max(doc_id)", "count(1)", "HashAggregate(keys=[]")
BATCH = [
    "revision_numbering", "order_numbering", "part_numbers", "path_rollup_usage", "copy_decision_branch",
    "node_records_all", "replay_with_carried_state", "dump_record_bytes", "split_assignment", "run_summary",
]


@pytest.mark.parametrize("name", BATCH)
def test_no_row_level_data_in_one_partition(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert any(mark in lines[i + 1] for mark in SMALL_BELOW_SINGLE), lines[i + 1]
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoop", plan)


def test_directory_adds_fold_before_the_shuffle(spark):
    plan = QUERIES["dir_adds_per_changelist"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan[plan.index("Exchange hashpartitioning"):]
