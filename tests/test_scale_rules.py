"""Scale rules, checked on the physical plan of every registered query.

No aggregate that gathers a whole group's values in one buffer (exact
``percentile``/``median``, ``mode``, ``collect_list``/``collect_set``), no
cartesian or nested-loop join, no Python UDF evaluation in any plan,
subqueries included.
"""

import re

import pytest

from staykit.registry import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = {
    "unbounded percentile": r"(?<!_)\bpercentile\(|\bmedian\(",
    "mode aggregate": r"\bmode\(",
    "collect aggregate": r"\bcollect_(list|set)\(",
    "cartesian / nested-loop join": r"CartesianProduct|BroadcastNestedLoopJoin",
    "python udf": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "local checkpoint": r"localCheckpoint",
    "round-robin shuffle": r"RoundRobinPartitioning",
    "single-reducer sketch": r"percentile_approx",
}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_follows_scale_rules(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    hits = [name for name, pat in FORBIDDEN.items() if re.search(pat, plan)]
    assert not hits, f"{key}: {hits}"
