"""Physical plans of the registered queries: nothing in them may grow on one task."""

import os
import re

import pytest

from checks.queries import QUERIES
from checks.tables import SCHEMAS

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")

# The trend works on the bounded head that a top-k has found.
BOUNDED_WINDOWS = {"trend_points"}
STREAMS = {"windowed_traffic", "windowed_counts", "alert_rules", "alert_json", "score_stream"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line) and name not in BOUNDED_WINDOWS:
            below = "".join(lines[i : i + 4])
            assert "SinglePartition" not in below, below
        if "Exchange SinglePartition" in line:
            # Only partial aggregates, one row per task, may meet on one task.
            partial = re.search(r"Aggregate\(keys?=\[\]", lines[i + 1])
            assert partial or name in BOUNDED_WINDOWS, lines[i + 1]


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [
        ("service_distribution", "lineitem", {"l_orderkey"}),
        ("top_sources", "lineitem", {"l_orderkey", "l_suppkey", "l_extendedprice", "l_discount"}),
        ("hour_distribution", "events", {"ts"}),
        ("label_distribution", "orders", {"o_orderkey", "o_orderstatus", "o_orderpriority"}),
    ],
)
def test_scans_read_only_what_they_use(spark, name, table, columns):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    prefix = SCHEMAS[table].split("_")[0] + "_" if table != "events" else ""
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = [{f.split(":")[0] for f in s.split(",")} for s in schemas]
    (found,) = [r for r in read if all(c.startswith(prefix) for c in r)]
    assert found == columns
