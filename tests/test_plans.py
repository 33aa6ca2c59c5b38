"""Plan checks: no cross products or unpartitioned windows on post-grain data; pruning reaches the scan."""
import pytest

from conftest import SF_SMALL
from quillspark.plans import q_cleaning as qc
from quillspark.plans import q_series as qs
from quillspark.plans import q_text as qt


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fn", [qc.clean_originals, qc.clean_replies, qc.clean_retweets, qs.asof_backward_rows,
                                qt.tfidf_weights])
def test_no_cartesian_on_post_grain(spark, fn):
    p = plan(fn(spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin BuildLeft, Inner" not in p


def test_asof_windows_see_dates_only(spark):
    p = plan(qs.asof_backward_rows(spark, SF_SMALL))
    # post rows (row_id) meet the resolved dates in a broadcast join and pass no window and no exchange
    for line in p.splitlines():
        if "Window [" in line or "Exchange hashpartitioning" in line:
            assert "row_id" not in line and "o_orderkey" not in line, line
    assert "BroadcastHashJoin" in p


def test_column_pruning_reaches_scan(spark):
    p = plan(qs.asof_backward_rows(spark, SF_SMALL))
    orders_scan = [l for l in p.splitlines() if "orders.parquet" in l and "ReadSchema" in l]
    assert orders_scan and all("o_totalprice" not in l for l in orders_scan)


def test_per_group_top_k_limits_before_shuffle(spark):
    # row_number() <= k: a partial WindowGroupLimit runs before the exchange, so at most k rows per group
    # and map partition are shuffled (the sample per class and the k-NN merge rely on this)
    p = plan(qc.route_preview(spark, SF_SMALL))
    lines = p.splitlines()
    wgl = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l]
    assert wgl, p
    assert any("Exchange" in l for l in lines[:wgl[0]])
