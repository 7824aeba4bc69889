"""Plan properties of every registered query (planning only, smallest scale)."""
import re

import pytest

from paperlane.plans.queries import REGISTRY
from tests.conftest import SF_SMALL

PYTHON_ALLOWED = {"translate_documents_distributed", "injected_document_function", "call_policy", "concurrent_calls",
                  "classify_invoice_learned"}
PUSHDOWN = {
    "lineage_summary_today": "GreaterThanOrEqual(ts,2024-01-30",
    "lineage_counts_yesterday": "LessThan(ts,2024-01-30",
    "lookback_filter": "GreaterThanOrEqual(ts,2024-01-10",
    "scan_process_log": "GreaterThanOrEqual(ts,2024-01-29",
    "message_window_filter": "GreaterThanOrEqual(o_orderdate",
}


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated scan descriptions
    out = {}
    for name, fn in REGISTRY.items():
        if name == "classify_invoice_learned":  # fitting a model runs jobs while planning
            continue
        out[name] = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_cross_joins(plans):
    bad = [n for n, p in plans.items() if "NestedLoopJoin" in p or "CartesianProduct" in p]
    assert bad == []


def test_python_only_where_designated(plans):
    py = [n for n, p in plans.items() if re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", p)]
    assert set(py) <= PYTHON_ALLOWED and "translate_documents_distributed" in py


@pytest.mark.parametrize("name,needle", sorted(PUSHDOWN.items()))
def test_filters_reach_the_scan(plans, name, needle):
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plans[name]))
    assert needle in pushed, pushed


@pytest.mark.parametrize("name, most", [("skip_if_exists", 6), ("skip_if_exists_both_outputs", 10), ("period_filter", 1)])
def test_scan_counts(plans, name, most):
    assert plans[name].count("Scan parquet") <= most
