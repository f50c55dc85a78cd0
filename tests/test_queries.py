"""Named queries against their SQL on the same tables.

All of them take several minutes; a spread over every group runs by default, everything
with ``ALL_QUERIES=1``.
"""

import os

import pytest

import __spark_entry__ as entry

from .compare import compare, connect
from .conftest import SMALL

SOME = ["preprocess", "validate_rows", "TelcoFeatures", "mutual_info_scores",
        "stratified_kfold", "describe_by_target", "missing_report", "compute_metrics",
        "sweep_thresholds", "net_value_at_topk", "business_eval", "latest_runs",
        "winning_config_run", "gate_score", "decide_winner", "drift_report", "ks_drift",
        "delayed_label_eval", "score_requests", "read_prediction_log", "error_rate"]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else SOME


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name]) == []


def test_entry_ranks_models(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 4 and {r["position"] for r in rows} == {1, 2, 3, 4}


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
