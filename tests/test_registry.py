"""The driver's contract: every registered query equals its SQL on the given tables, and no plan compares all with all."""

import os
import re

import pytest

import __spark_entry__ as entry
from sixfold.plans.registry import ALL

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")

# Ranks over one row per team.
RANKED = {"team_ranking"}


@pytest.fixture(scope="module")
def con():
    from tools.compare import oracle

    return oracle(SMALL)


def test_names_and_keys():
    assert entry.queries().keys() >= entry.oracle_sql().keys()
    assert len(ALL) >= 75
    assert {n for n, (_, sql) in ALL.items() if sql is None} == {"pca2"}


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, con, name):
    from tools.compare import compare

    df = entry.queries()[name](spark, SMALL)
    check_plan(name, df._jdf.queryExecution().executedPlan().toString())
    assert compare(con, df, entry.oracle_sql().get(name)) == ""


def check_plan(name, plan):
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in ("embedded_documents", "embedded_messages"):
        assert not re.search("ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", plan)
    # A window over all rows in one task stands only on a table whose size is bounded.
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for i, line in enumerate(lines):
        if re.match(r"^[\s:+\-*()\d]*Window ", line):
            below = "\n".join(x for x in lines[i + 1 : i + 4] if depth(x) > depth(line))
            if "SinglePartition" in below and "TakeOrderedAndProject" not in below:
                assert "_bucket" in line or name in RANKED, line
