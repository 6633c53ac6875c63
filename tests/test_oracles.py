"""Every registered query: equal to its oracle and free of plans that do not scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import compare  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from tallyward import gallery  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# The queries of the reference's own operators; those of tallyward.llm have their tests in tests/llm.
gallery.load()
QUERIES, ORACLES = gallery.QUERIES, gallery.ORACLES
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")

# Nested-loop and cross joins, row-wise Python and one-task windows have no place in a plan.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "FlatMapGroupsInPandas"]


@pytest.fixture(scope="module")
def oracle():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    assert name in ORACLES
    assert compare.compare(df, oracle, ORACLES[name]) in ("", "both empty")


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "signal_key" and df.schema == entry_module.entry(spark).schema
